"""Per-pixel metrics over the periods of a season year.

One hash aggregate covers all of them: a slot for each period and column that the chosen metrics read, and the periods that
are there. A pixel's slots become arrays (``slots``): the values by period, in their own order, and in the
order of a key (greenness, temperature). Metrics are expressions over those arrays, and users add theirs with ``register``.
Missing values follow one table: the minimum skips them, everything else propagates them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelseries.sources.adapter import BANDS, PIXEL

B7 = BANDS
B8 = [*BANDS, "ndvi"]
#: Keys that periods are ordered by, and their columns.
KEYS = {"green": "ndvi", "temp": "therm"}
PERIODS = 12
#: A key with ties broken by period: one long, so that the aggregate's states are plain numbers.
RANK = "cast({} as long) * 32 + period"
#: What a metric may ask for of its columns.
KINDS = ("series", "own", *KEYS)


def series(b: str) -> Column:
    """The values by period; null where a period is missing or has none."""
    return F.col(f"series_{b}")


def own(b: str) -> Column:
    """The values that are there, in ascending order."""
    return F.col(f"own_{b}")


def by_key(key: str, b: str) -> Column:
    """The values of all periods that are there, in ascending order of a key; ties in order of time, periods without key first."""
    return F.col(f"{key}_{b}")


def base_column(label: str) -> str:
    """The column that a label of features is read from: ``b1`` of ``b1-p00``."""
    return label.split("-")[0]


def slots(comp: DataFrame, needs: dict[str, Iterable[str]], periods: int = PERIODS) -> DataFrame:
    """One row per pixel: ``n``, the number of its periods, and the arrays of each kind for the columns that ``needs`` has by kind."""
    unknown = sorted(set(needs) - set(KINDS))
    if unknown:
        raise ValueError(f"metrics can ask for {KINDS}, not for {unknown}")
    needs = {kind: sorted(set(columns)) for kind, columns in needs.items()}
    keys = [k for k in KEYS if needs.get(k)]
    read = sorted({c for columns in needs.values() for c in columns})
    # One expression string each: far fewer calls to the JVM than columns put together one by one.
    cells = [F.expr(f"max(if(period = {k}, cast({c} as double), null)) as {c}_{k}") for c in read for k in range(periods)]
    cells += [F.expr(f"max(if(period = {k}, {RANK.format(KEYS[key])}, null)) as {key}_at_{k}") for key in keys for k in range(periods)]
    wide = comp.groupBy(*PIXEL).agg(F.expr("bit_or(shiftleft(1L, period)) as held"), *cells)
    arrays = [f"array({', '.join(f'{c}_{k}' for k in range(periods))}) as series_{c}" for c in read]
    for key in keys:
        each = ", ".join(f"named_struct('k', {key}_at_{k}, 'p', {k})" for k in range(periods))
        arrays.append(f"sort_array(filter(array({each}), x -> getbit(held, x.p) = 1)) as {key}_order")
    wide = wide.selectExpr(*PIXEL, "cast(bit_count(held) as int) as n", *arrays)
    made = [f"sort_array(array_compact(series_{c})) as own_{c}" for c in needs.get("own", ())]
    for key in keys:
        made.append(f"size(filter({key}_order, x -> x.k is null)) as {key}_unknown")
        made += [f"transform({key}_order, x -> get(series_{c}, x.p)) as {key}_{c}" for c in needs[key]]
    return wide.selectExpr(*PIXEL, "n", *[f"series_{c}" for c in needs.get("series", ())], *made)


def _mean(values: str, places: list[str]) -> str:
    """The mean of the values at some places of an array; one that is missing makes it missing."""
    return "(" + " + ".join(f"get({values}, {at})" for at in places) + f") / {len(places)}"


def lowest(b: str) -> Column:
    return F.expr(f"get(own_{b}, 0)")


def highest(b: str) -> Column:
    return F.expr(f"if(size(own_{b}) = n, get(own_{b}, n - 1), null)")


def median(b: str) -> Column:
    return F.expr(f"if(size(own_{b}) = n, (get(own_{b}, cast((n - 1) div 2 as int)) + get(own_{b}, cast(n div 2 as int))) / 2, null)")


def lowest_mean(b: str, k: int) -> Column:
    return F.expr(_mean(f"own_{b}", [str(i) for i in range(k)]))


def top_mean(key: str, b: str, k: int) -> Column:
    """Mean over the k periods with the highest key."""
    return F.expr(_mean(f"{key}_{b}", [f"n - {i + 1}" for i in range(k)]))


def at_middle(key: str, b: str) -> Column:
    """Value at ascending index floor(n / 2)."""
    return F.expr(f"get({key}_{b}, cast(n div 2 as int))")


def at_highest(key: str, b: str) -> Column:
    return F.expr(f"if({key}_unknown < n, get({key}_{b}, n - 1), null)")


def at_lowest(key: str, b: str) -> Column:
    return F.expr(f"get({key}_{b}, {key}_unknown)")


def warmest_mean(k: int = 3) -> Column:
    """Mean of the k highest temperatures; any missing period makes it missing."""
    return F.expr(f"if(size(own_b31) = n, {_mean('own_b31', [f'n - {i + 1}' for i in range(k)])}, null)")


def amplitude(b: str) -> Column:
    return F.expr(f"if(size(own_{b}) = n, get(own_{b}, n - 1) - get(own_{b}, 0), null)")


def ranked_amplitude(key: str, b: str) -> Column:
    return at_highest(key, b) - at_lowest(key, b)


@dataclass(frozen=True)
class Metric:
    """A named family of features: their labels, the value of a label, what it says, and the kinds of arrays that it reads.

    A label is a column of composites, or begins with one and a hyphen. ``needs`` are of ``KINDS``; the value is an
    expression over ``series``, ``own``, ``by_key`` of the label's column, and ``n``.
    """

    bands: tuple[str, ...]
    value: Callable[[str], Column]
    says: str
    needs: tuple[str, ...] = ("series",)


def built_in() -> dict[str, Metric]:
    b7, b8 = tuple(B7), tuple(B8)
    period = lambda label: F.expr(f"get(series_{base_column(label)}, {int(label[-2:])})")
    found = {
        "unsorted_monthly": Metric(tuple(f"{b}-p{k:02d}" for k in range(PERIODS) for b in b8), period, "value of a period"),
        "band_min": Metric(b8, lowest, "lowest value", ("own",)),
        "band_median": Metric(b8, median, "median value", ("own",)),
        "band_max": Metric(b8, highest, "highest value", ("own",)),
        "band_amplitude": Metric(b8, amplitude, "highest less lowest value", ("own",)),
        "amp_greenest": Metric(b8, amplitude, "amplitude over periods in order of greenness", ("own",)),
        "amp_warmest": Metric(b8, amplitude, "amplitude over periods in order of temperature", ("own",)),
        "temp_mean_warmest3": Metric(("b31",), lambda b: warmest_mean(3), "mean temperature of the 3 warmest periods", ("own",)),
        "temp_mean_greenest3": Metric(("b31",), lambda b: top_mean("green", b, 3), "mean temperature of the 3 greenest periods", ("green",)),
    }
    for name, most, least in (("green", "greenest", "least green"), ("temp", "warmest", "coldest")):
        found |= {
            f"{name}_max": Metric(b8, lambda b, n=name: at_highest(n, b), f"value at the {most} period", (name,)),
            f"{name}_median": Metric(b8, lambda b, n=name: at_middle(n, b), f"value at the middle period from {least}", (name,)),
            f"{name}_min": Metric(b8, lambda b, n=name: at_lowest(n, b), f"value at the {least} period", (name,)),
        }
    for k in (3, 6, 8):
        found |= {
            f"lowest_{k}_mean": Metric(b7, lambda b, k=k: lowest_mean(b, k), f"mean of the {k} lowest values", ("own",)),
            f"greenest_{k}_mean": Metric(b8, lambda b, k=k: top_mean("green", b, k), f"mean over the {k} greenest periods", ("green",)),
            f"warmest_{k}_mean": Metric(b8, lambda b, k=k: top_mean("temp", b, k), f"mean over the {k} warmest periods", ("temp",)),
        }
    return found


_users: dict[str, Metric] = {}


def register(name: str, metric: Metric) -> None:
    """Add a metric to those that the catalog, feature tables and runs know; a name that is taken is an error."""
    if name in registry():
        raise ValueError(f"there is a metric {name!r} already")
    unknown = sorted(set(metric.needs) - set(KINDS))
    if unknown or not metric.bands:
        raise ValueError(f"metric {name!r} asks for {unknown or 'no bands'}; it can ask for {KINDS}")
    _users[name] = metric


def unregister(name: str) -> None:
    """Take a user's metric back."""
    del _users[name]


def registry() -> dict[str, Metric]:
    return built_in() | _users


def needs_of(metrics: Iterable[Metric]) -> dict[str, set[str]]:
    """What several metrics ask for together, by kind."""
    needs: dict[str, set[str]] = {}
    for m in metrics:
        for kind in m.needs:
            needs.setdefault(kind, set()).update(map(base_column, m.bands))
    return needs


def unsorted_monthly(comp: DataFrame) -> DataFrame:
    """Wide: every band of every period, ``<band>_p<period>``."""
    cells = [F.max(F.when(F.col("period") == k, F.col(b).cast("double"))).alias(f"{b}_p{k:02d}") for k in range(PERIODS) for b in B8]
    return comp.groupBy(*PIXEL).agg(*cells)


def sorted_by_self(comp: DataFrame) -> DataFrame:
    """(pixel key, band, pos, value): values of a band in order, missing ones last."""
    wide = slots(comp, {"own": B8})
    nulls = lambda b: F.array_repeat(F.lit(None).cast("double"), F.col("n") - F.size(own(b)))
    cells = F.array(*[F.struct(F.lit(b).alias("band"), F.concat(own(b), nulls(b)).alias("s")) for b in B8])
    return wide.select(*PIXEL, F.inline(cells)).select(*PIXEL, "band", F.posexplode("s").alias("pos", "value"))


def to_long(wide: DataFrame, columns: dict[str, Column], label: str = "band") -> DataFrame:
    """(pixel key, label, value) from one expression per label."""
    return to_long_by(wide, {(name,): c for name, c in columns.items()}, [label])


def to_long_by(wide: DataFrame, columns: dict[tuple, Column], labels: list[str]) -> DataFrame:
    """(pixel key, labels, value) from one expression per tuple of labels, all over one reading of ``wide``."""
    cells = [F.struct(*[F.lit(x).alias(n) for x, n in zip(key, labels)], c.cast("double").alias("value")) for key, c in columns.items()]
    return wide.select(*PIXEL, F.inline(F.array(*cells)))


def metric_long(comp: DataFrame, name: str) -> DataFrame:
    metric = registry()[name]
    return to_long(slots(comp, needs_of([metric])), {b: metric.value(b) for b in metric.bands})
