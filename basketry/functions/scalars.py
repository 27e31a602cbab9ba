"""Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels that appear in reports.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
DAY_SHORT = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
GAP_BINS = [(0, 2, "0-2"), (2, 5, "3-5"), (5, 8, "6-8"), (8, 15, "9-15"), (15, 30, "16-30"), (30, 60, "31-60")]
MISSING = "missing"
# End of the fixed values.


def normalized_key(text: Column) -> Column:
    """Trimmed lower-case key; null becomes ``missing``."""
    return F.lower(F.trim(F.coalesce(text, F.lit(MISSING))))


def lookup(key: Column, table: dict[str, str], default: str = MISSING) -> Column:
    """Value of a short literal dictionary, or the value of its default key."""
    pairs = F.create_map(*[F.lit(x) for item in table.items() for x in item])
    return F.coalesce(pairs[key], F.lit(table.get(default)))


def forward_slashes(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def synthetic_title(title: Column | None, product_id: Column) -> Column:
    made = F.concat(F.lit("Product "), product_id.cast("string"))
    return made if title is None else F.coalesce(title, made)


def ellipsis(text: Column, limit: int = 45, keep: int | None = None, tail: str = "...") -> Column:
    """Cut ``text`` longer than ``limit`` to its first ``keep`` characters plus ``tail``."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit if keep is None else keep), F.lit(tail))).otherwise(text)


def purchase_badge(count: Column) -> Column:
    times = F.concat(count.cast("string"), F.lit("x before"))
    return (
        F.when(count >= 3, F.concat(F.lit("⭐ Bought "), times))
        .when(count > 1, F.concat(F.lit("✓ Bought "), times))
        .when(count.isNotNull(), F.lit("✓ Bought before"))
    )


def day_name(day: Column, names: Sequence[str] = DAY_NAMES) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), day.cast("int") + 1)


def right_closed_bin(value: Column, bins: Sequence[tuple[float, float, str]] = GAP_BINS) -> Column:
    """Label of the (low, high] bin; values at or below the lowest edge get none."""
    label = F.lit(None).cast("string")
    for low, high, name in reversed(bins):
        label = F.when((value > low) & (value <= high), F.lit(name)).otherwise(label)
    return label


def log1p_floor0(value: Column) -> Column:
    """``log1p`` of the value, negative values taken as 0; null stays null."""
    x = value.cast("double")
    return F.log1p(F.when(x < 0, F.lit(0.0)).otherwise(x))


def confidence(count: Column, alpha: float = 40.0) -> Column:
    return F.lit(1.0) + F.lit(float(alpha)) * count


def logit(p: Column, compat: bool = False, eps: float = 1e-8) -> Column:
    """Log odds. ``compat`` gives ``ln(clip(p, eps, 1 - p))``, the formula published scores used."""
    if compat:
        return F.log(F.least(F.greatest(p, F.lit(eps)), F.lit(1.0) - p))
    q = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    return F.log(q / (F.lit(1.0) - q))


def parse_id_list(text: Column) -> Column:
    """Ids in a comma list; parts that are not all digits, or too large for an id, are skipped."""
    digits = F.filter(F.transform(F.split(text, ","), lambda part: F.trim(part)), lambda part: part.rlike("^[0-9]+$"))
    return F.array_compact(F.transform(digits, lambda part: part.try_cast("bigint")))


def dot(u: Column, v: Column) -> Column:
    products = F.zip_with(u, v, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(u: Column, v: Column) -> Column:
    """Cosine of two vectors; 0 when one of them is all zero."""
    norms = F.sqrt(dot(u, u)) * F.sqrt(dot(v, v))
    return F.when(norms > 0, dot(u, v) / norms).otherwise(F.lit(0.0))


def weighted_ensemble(weights: dict[str, float]) -> Column:
    """Linear mix of score columns."""
    mix = F.lit(0.0)
    for name, weight in weights.items():
        mix = mix + F.lit(float(weight)) * F.col(name)
    return mix
