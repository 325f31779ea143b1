"""Arithmetic on arrays of numbers as Catalyst expressions. Arrays are taken as doubles; nulls make results null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x)


def _fold(a: Column, b: Column, f) -> Column:
    return total(F.zip_with(doubles(a), doubles(b), f))


def dot(a: Column, b: Column) -> Column:
    return _fold(a, b, lambda x, y: x * y)


def l1(a: Column, b: Column) -> Column:
    return _fold(a, b, lambda x, y: F.abs(x - y))


def l2sq(a: Column, b: Column) -> Column:
    return _fold(a, b, lambda x, y: (x - y) * (x - y))


def chi2(a: Column, b: Column, eps: float = 1e-10) -> Column:
    return 0.5 * _fold(a, b, lambda x, y: (x - y) * (x - y) / (x + y + eps))


def intersection(a: Column, b: Column) -> Column:
    return _fold(a, b, lambda x, y: F.least(x, y))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def norm(v: Column, p: float = 2) -> Column:
    """p = 0 counts elements, -1 is the largest magnitude; other powers are of the elements as they are."""
    v = doubles(v)
    if p == 0:
        return F.size(v).cast("double")
    if p == -1:
        return F.array_max(F.transform(v, F.abs))
    if p == 1:
        return total(F.transform(v, F.abs))
    return F.pow(total(F.transform(v, lambda x: F.pow(x, F.lit(p)))), F.lit(1 / p))


def scale(v: Column, by: Column) -> Column:
    return F.transform(doubles(v), lambda x: x * by)


def normalized(v: Column, p: float = 2) -> Column:
    """Divided by its norm; a zero vector becomes null elements, not infinities."""
    n = norm(v, p)
    return F.transform(doubles(v), lambda x: F.try_divide(x, n))


def normalized_clipped(v: Column, top: float) -> Column:
    """Normalised, cut at ``top``, and normalised again if anything was cut."""
    once = normalized(v)
    cut = F.transform(once, lambda x: F.least(x, F.lit(top)))
    return F.when(F.exists(once, lambda x: x > top), normalized(cut)).otherwise(once)


def signed_power(v: Column, a: float) -> Column:
    return F.transform(doubles(v), lambda x: F.signum(x) * F.pow(F.abs(x), F.lit(a)))


def entropy(v: Column) -> Column:
    """Base 2, of non-negative parts as they are; zeros add nothing."""
    return -total(F.transform(F.filter(doubles(v), lambda x: x > 0), lambda x: x * F.log2(x)))


def cumulated(v: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(v)), lambda i: total(F.slice(doubles(v), 1, i)))


def finite(v: Column) -> Column:
    """Without nulls, NaN and infinities."""
    return F.filter(doubles(v), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def count_in(v: Column, low: float, high: float) -> Column:
    """Elements in [low, high)."""
    return F.size(F.filter(doubles(v), lambda x: (x >= low) & (x < high)))


def arg_max(v: Column) -> Column:
    """0-based place of the first largest element."""
    return F.array_position(doubles(v), F.array_max(doubles(v))).cast("int") - 1


def clipped_histogram(v: Column, low: float, high: float, k: int) -> Column:
    """Counts in k equal bins; what lies outside goes to the first or last, NaN to none."""
    bins = F.transform(F.filter(doubles(v), lambda x: ~F.isnan(x)), lambda x: F.least(F.lit(k - 1), F.greatest(F.lit(0), F.floor((x - low) * k / (high - low)).cast("int"))))
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.size(F.filter(bins, lambda b: b == i)))


def median_of(v: Column) -> Column:
    """The middle element, or the mean of the two middle ones."""
    s, n = F.array_sort(doubles(v)), F.size(v)
    return (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2


def polynomial2(v: Column) -> Column:
    """Products of all pairs i <= j, mixed ones times the root of two, so that dot products are squared."""
    v = doubles(v)
    pair = lambda i: F.transform(F.sequence(i, F.size(v) - 1), lambda j: F.get(v, i) * F.get(v, j) * F.when(i == j, 1.0).otherwise(2**0.5))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(v) - 1), pair))


def sparse(v: Column) -> Column:
    """map<int, double> of the non-zero elements."""
    idx = F.filter(F.transform(doubles(v), lambda x, i: F.struct(i.alias("key"), x.alias("value"))), lambda e: e["value"] != 0)
    return F.map_from_entries(idx)


def sparse_dot(a: Column, b: Column) -> Column:
    return total(F.map_values(F.map_zip_with(a, b, lambda _, x, y: F.coalesce(x, F.lit(0.0)) * F.coalesce(y, F.lit(0.0)))))


def sign_code(v: Column, start: int, bits: int = 64) -> Column:
    """Long whose bit i is set where element start + i is positive; up to 64 bits."""
    part = F.slice(doubles(v), start + 1, bits)
    return F.aggregate(F.transform(part, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(x))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def mapped(v: Column, f) -> Column:
    return F.transform(doubles(v), f)


def paired(a: Column, b: Column, f) -> Column:
    return F.zip_with(doubles(a), doubles(b), f)


def product(v: Column) -> Column:
    return F.aggregate(doubles(v), F.lit(1.0), lambda s, x: s * x)


def differences(v: Column) -> Column:
    """Each element less the one before it; one shorter."""
    v = doubles(v)
    return F.zip_with(F.slice(v, 2, F.size(v)), F.slice(v, 1, F.greatest(F.lit(0), F.size(v) - 1)), lambda x, y: x - y)


def quantile_of(v: Column, q: float) -> Column:
    """Linear between the two elements next to the place."""
    s, at = F.array_sort(doubles(v)), (F.size(v) - 1) * F.lit(q)
    low, high = (F.get(s, f(at).cast("int")) for f in (F.floor, F.ceil))
    return low + (high - low) * (at - F.floor(at))


def sorting_index(v: Column) -> Column:
    """Places of the elements in ascending order, equal ones by place."""
    return F.transform(F.array_sort(F.transform(doubles(v), lambda x, i: F.struct(x.alias("x"), i.alias("i")))), lambda s: s["i"])


def inverted(permutation: Column) -> Column:
    """Where each place went."""
    pairs = F.array_sort(F.transform(permutation, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    return F.transform(pairs, lambda s: s["i"])


def ranks(v: Column) -> Column:
    """0-based rank of each element, equal ones by place."""
    return inverted(sorting_index(v))


def permuted(v: Column, permutation: Column) -> Column:
    return F.transform(permutation, lambda i: F.get(v, i))


def found(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Add place (0-based, in the sorted array, -1 if absent), times and kinds (distinct elements)."""
    v = F.col(column)
    times = F.size(F.filter(v, lambda x: x == value)).cast("long")
    return df.withColumn("place", F.array_position(F.array_sort(v), value).cast("int") - 1).withColumn("times", times).withColumn("kinds", F.size(F.array_distinct(v)).cast("long"))


def scattered(df: DataFrame, group: str, slots: Column, values: Column) -> DataFrame:
    """(group, slot, total): values added up where their slots say."""
    pairs = df.select(group, F.explode(F.arrays_zip(slots.alias("slot"), values.alias("x"))).alias("p"))
    return pairs.groupBy(group, F.col("p.slot").cast("int").alias("slot")).agg(F.sum("p.x").alias("total"))


def replaced(v: Column, which, by: float) -> Column:
    return F.transform(doubles(v), lambda x: F.when(which(x), F.lit(by)).otherwise(x))


def span(start: Column, n: int, step: int = 1) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (start + i * step).cast("int"))


def seeded(key: Column, n: int, seed: int) -> Column:
    """n numbers in [0, 1) that depend on key and seed alone, not on how rows are spread."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.pmod(F.xxhash64(key, F.lit(seed), i), F.lit(1 << 53)).cast("double") / float(1 << 53))


def polynomial3(v: Column) -> Column:
    """Products of all triples i <= j <= k, times the root of how many orders each has, so that dot products are cubed."""
    v = doubles(v)
    many = lambda i, j, k: F.when((i == j) & (j == k), 1.0).when((i == j) | (j == k), 3**0.5).otherwise(6**0.5)
    third = lambda i, j: F.transform(F.sequence(j, F.size(v) - 1), lambda k: F.get(v, i) * F.get(v, j) * F.get(v, k) * many(i, j, k))
    second = lambda i: F.flatten(F.transform(F.sequence(i, F.size(v) - 1), lambda j: third(i, j)))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(v) - 1), second))
