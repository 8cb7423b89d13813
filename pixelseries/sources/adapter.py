"""Pixel observations from the order tables, with the shapes of real reflectance tables.

A supplier is a pixel, its nation and region a tile, the 16-day window of a ship date a
composite date. Line items give the layers of a CH row (bands 3-7 and 31) and a CQ row
(bands 1, 2, state, zenith) for each pixel and date. A season year starts at day 65.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIXEL = ["h", "v", "season_year", "pixel"]
FILL = {**{f"b{k}": -28672 for k in range(1, 8)}, "b31": 0, "zenith": 255}
CH_BANDS = ["b3", "b4", "b5", "b6", "b7", "b31"]
CQ_BANDS = ["b1", "b2"]
BANDS = [f"b{k}" for k in range(1, 8)]
ALL_BANDS = [*BANDS, "b31"]
PREFIX = "REF44"
COLLECTION = "006"
DATES = 23

_held: dict[tuple, tuple] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """Several queries read the same intermediate tables: persist each once for a session and state of the folder's files."""
    files = spark.read.format("binaryFile").load([f"{sf_dir}/{t}.parquet" for t in ("lineitem", "supplier", "nation")])
    newest = files.agg(F.max("modificationTime")).first()[0]
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key in _held and _held[key][0] != newest:
        _held.pop(key)[1].unpersist()
    if key not in _held:
        _held[key] = newest, make().persist()
    return _held[key][1]


def release() -> None:
    """Let go of all tables that are held."""
    while _held:
        _held.popitem()[1][1].unpersist()


def season_columns(year: Column, doy: Column) -> dict[str, Column]:
    """season_year and idx of a composite date (closed form of 23 dates from day 65 in steps of 16)."""
    return {
        "season_year": F.when(doy >= 65, year).otherwise(year - 1).cast("int"),
        "idx": F.when(doy >= 65, F.floor((doy - 65) / 16)).otherwise(F.floor((doy - 1) / 16) + 19).cast("int"),
    }


def composite_date(ship: Column) -> tuple[Column, Column]:
    """Year and day of it of the 16-day window that a date lies in."""
    doy = F.dayofyear(ship)
    return F.year(ship), doy - 1 - (doy - 1) % 16 + 1


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with pixel, tile and composite date."""
    year, date = composite_date(F.col("l_shipdate"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_nationkey").cast("int").alias("h"),
            F.col("n_regionkey").cast("int").alias("v"),
            F.col("l_suppkey").cast("long").alias("pixel"),
            (year * 1000 + date).cast("int").alias("day"),
            *[c.alias(k) for k, c in season_columns(year, date).items()],
            F.col("l_orderkey").alias("o"),
            F.col("l_linenumber").alias("n"),
            F.col("l_partkey").alias("p"),
            F.col("l_shipdate").alias("ship"),
            F.col("l_linestatus").alias("status"),
            F.col("l_returnflag").alias("flag"),
            F.floor("l_quantity").cast("int").alias("q"),
            F.floor("l_extendedprice").cast("int").alias("x"),
            F.round(F.col("l_discount") * 100).cast("int").alias("d"),
            F.round(F.col("l_tax") * 100).cast("int").alias("t"),
        )
    )


#: A packed value has so many bits, three to a long; layers have 16-bit values.
VALUE_BITS = 20


def pack(values: list[Column]) -> Column:
    """Up to three small integers as a long; nulls keep their place as 0."""
    half, out = 1 << (VALUE_BITS - 1), F.lit(0).cast("long")
    for value in values:
        out = out * (1 << VALUE_BITS) + F.coalesce(value.cast("long") + half, F.lit(0))
    return out


def unpack(packed: Column, names: list[str]) -> list[Column]:
    half, mask = 1 << (VALUE_BITS - 1), (1 << VALUE_BITS) - 1
    field = lambda k: F.shiftright(packed, VALUE_BITS * (len(names) - 1 - k)).bitwiseAND(mask)
    return [(F.nullif(field(k), F.lit(0).cast("long")) - half).cast("int").alias(name) for k, name in enumerate(names)]


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """obs: raw layers of both products by pixel and date.

    A pixel and date takes its CH layers from the first of its line items in one order, its CQ layers from the
    first in another. Orders are packed into decimals of fixed width and layers into longs, so that all states are plain
    numbers: one hash aggregate and no sort. The one exchange deals line items by pixel as they are: they are half as wide as
    states, a scan holds few of a pixel and date, and what is computed of observations by pixel needs no further exchange.
    """
    days = F.unix_date(F.to_date("ship")).alias("ship")
    rows = base(spark, sf_dir).select(*PIXEL, days, "o", "n", "p", "q", "x", "d", "t").repartition(*PIXEL)
    year, date = composite_date(F.date_from_unix_date("ship"))
    wide = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    tens = lambda k: F.lit("1" + "0" * k).cast(f"decimal({k + 1},0)")
    line = F.col("o") * 1000 + F.col("n")
    ship = F.col("ship") + 100_000
    ranks = {
        "ch": line.cast("decimal(18,0)") * tens(18) + (F.col("p") * 1_000_000 + ship).cast("decimal(18,0)"),  # o, n, p, ship
        "cq": wide("p", 13) * tens(24) + line.cast("decimal(18,0)") * tens(6) + ship.cast("decimal(6,0)"),  # p, o, n, ship
    }
    layers = {
        "b3": "if(o % 53 = 0, -28672, q * 60 + d * 7)", "b4": "q * 55 + t * 9", "b5": "x % 5000", "b6": "x % 4000 + d", "b7": "x % 3000 + t",
        "b31": "if(o % 97 = 0, 0, 14000 + x % 1500)", "b1": "if(p % 53 = 0, -28672, q * 20 - 100)", "b2": "x % 6000",
        "state": """if(d = 10 and n % 2 = 0, 1, 0) + if(t = 8 and n % 2 = 1, 4, 0) + if(p % 32 = 0, 192, (p % 3) * 64) + if(o % 32 = 0, 8192, 0)""",
        "zenith": "if(o % 101 = 0, 255, 20 + p % 54)",
    }
    groups = [("ch", ["b3", "b4", "b5"]), ("ch", ["b6", "b7", "b31"]), ("cq", ["b1", "b2", "state"]), ("cq", ["zenith"])]
    packed = [pack([F.expr(layers[name]) for name in names]).alias(f"v{k}") for k, (_, names) in enumerate(groups)]
    keyed = rows.select(*PIXEL, (year * 1000 + date).cast("int").alias("day"), *[rank.alias(f"{side}_rank") for side, rank in ranks.items()], *packed)
    first = keyed.groupBy(*PIXEL, "day").agg(*[F.max_by(f"v{k}", f"{side}_rank").alias(f"v{k}") for k, (side, _) in enumerate(groups)])
    idx = season_columns(F.expr("day div 1000"), F.col("day") % 1000)["idx"].alias("idx")
    found = first.select(*PIXEL, "day", idx, *[c for k, (_, names) in enumerate(groups) for c in unpack(F.col(f"v{k}"), names)])
    return found.select(*PIXEL, "day", "idx", *ALL_BANDS, "state", "zenith")


def granules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names as a tile archive would hold them: two to three versions of each date and product."""
    rows = base(spark, sf_dir)
    two = lambda c: F.lpad(F.col(c).cast("string"), 2, "0")

    def named(product: str, version: str) -> DataFrame:
        each = rows.groupBy("h", "v", "day", version).agg(F.max("o").alias("stamp"))
        return each.select(
            F.concat(
                F.lit(f"{PREFIX}{product}.A"), F.col("day").cast("string"), F.lit(".h"), two("h"), F.lit("v"), two("v"),
                F.lit(f".{COLLECTION}."), F.lpad(F.col("stamp").cast("string"), 13, "0"), F.lit(".hdf"),
            ).alias("path")
        )

    return named("CH", "status").unionByName(named("CQ", "flag"))


def bad_names(names: DataFrame) -> DataFrame:
    """The same names with a product that does not exist, and with tiles that do not parse."""
    return names.select(
        F.explode(
            F.array(
                F.regexp_replace("path", r"C[HQ]\.A", "CX.A"),
                F.regexp_replace("path", r"\.h(\d\dv\d\d)\.", ".y$1."),
                F.regexp_replace("path", r"\.h(\d\dv\d\d)\.", ".h0$1."),
            )
        ).alias("path")
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pixels: every supplier in every season year that the line items touch, complete or not."""
    lines = table(spark, sf_dir, "lineitem")
    first, last = (lines.select(f(F.year("l_shipdate"))).scalar() for f in (F.min, F.max))
    years = F.explode(F.sequence(first - 1, last))  # a season year begins at most a year before its dates
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_nationkey").cast("int").alias("h"),
            F.col("n_regionkey").cast("int").alias("v"),
            years.alias("season_year"),
            F.col("s_suppkey").cast("long").alias("pixel"),
            (F.floor(F.abs("s_acctbal")) % 101).cast("int").alias("label"),
        )
    )
