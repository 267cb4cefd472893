"""URL filter: allow and block rules on hosts and path prefixes, by a sort-merge range join.

A rule is a host and a path prefix. It fits its host and all subdomains of it when
the URL's path starts with the rule's. With the labels of a host written in reverse
(``www.a.org`` is ``org.a.www.``), "this host or below it" is a prefix of the key, and
a prefix is an interval of the sorted keys; a path prefix is one within its host.

The join is one sweep, used twice. Points (URLs) and intervals (rules) are dealt to ranges
of the sorted key space, a rule to every range its interval meets, and each range is read in
order with a stack of the rules that are open: rules nest, so what is open is a chain, and a
rule that is no prefix of the current key is closed for good.

1. Reversed hosts against the distinct rule hosts: the chain of rule hosts above each URL.
2. (rule host, path) of each URL and each host of its chain, against the rules: the deepest
   open rule is the longest of that host.

The longest of a URL's rules decides. A range holds any number of rows in bounded memory: only the
open chain and a batch are kept. The cut points come from a bounded sample of the keys
(``SAMPLE`` for each range) and carry a random part, so that a host, or one URL repeated in a third of the
rows, is dealt over many ranges. They only balance the work; the result does not depend on them.

Defined results
* Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case (a port or
  user name is part of it). Path: what follows up to ``?``, ``#`` or the end. A null URL or one
  without ``://`` has an empty host and path, and no rule fits it.
* The longest rule is the one with most characters in host and path together; of equal ones that with the
  longer host. Rules that repeat a host and path count once; ``block`` wins over ``allow``.
* A rule without host or verdict fits nothing; a null path counts as empty (any path).
* A URL without a fitting rule gets the ``default`` verdict (``allow``) and a null rule.
* Every input row gives one output row, repeated ones too. Null ids stay. Empty tables give no rows.
  Other columns of the input may have any name; only those in ``keep`` are returned.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .shared import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A range is made for so many keys (and one for each shuffle partition at least), from so many sampled keys.
RANGE_ROWS = 1_000_000
SAMPLE = 16

#: Cut points keep so many characters of a path or host key.
CLIP = 256

_SALTS = 1 << 20
_FOUND = "array<struct<p: string, tag: string>>"


def host_of(url: Column) -> Column:
    rest = _after_scheme(url)
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    """The labels in reverse, a dot behind each: a domain's key is a prefix of its subdomains' keys."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: Iterable[Sequence[str]]) -> DataFrame:
    """(host, path, verdict) rows from such tuples."""
    return spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")


def judge(pages: DataFrame, rules: DataFrame, keep: Sequence[str] = ("page_id",), url: str = "url", default: str = "allow") -> DataFrame:
    """``keep``, host, path, rule and verdict of every row of ``pages``."""
    spark = pages.sparkSession
    rules = (
        rules.select(
            F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("verdict")
        )
        .where("host <> '' and verdict is not null")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    rows = pages.select(F.struct(*[pages[f"`{c}`"] for c in keep]).alias("kept"), pages[f"`{url}`"].alias("u"))
    rows = rows.select("kept", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    rows = rows.select(F.struct(F.monotonically_increasing_id().alias("row"), "kept", "host", "path").alias("page"))

    hosts = rules.select("host").distinct().select(F.lit("").alias("h"), host_key(F.col("host")).alias("p"), F.col("host").alias("tag"))
    points = rows.select("page", F.lit("").alias("h"), host_key(F.col("page.host")).alias("p"))
    chains = staged(sweep(points, hosts, "page", deepest=False), "url-chains")

    inner = rules.select(host_key(F.col("host")).alias("h"), F.col("path").alias("p"), F.col("verdict").alias("tag"))
    points = chains.select("page", F.explode("found").alias("above")).select(
        F.struct(F.col("page.row").alias("row"), F.col("above.tag").alias("rule_host")).alias("probe"),
        F.col("above.p").alias("h"),
        F.col("page.path").alias("p"),
    )
    hits = sweep(points, inner, "probe", deepest=True).where(F.size("found") > 0)
    rule = F.struct(
        (F.length("probe.rule_host") + F.length(F.col("found")[0].p)).alias("n"),
        F.length("probe.rule_host").alias("n_host"),
        F.concat("probe.rule_host", F.col("found")[0].p).alias("rule"),
        F.col("found")[0].tag.alias("verdict"),
    )
    best = hits.groupBy(F.col("probe.row").alias("row")).agg(F.max(rule).alias("best"))
    out = chains.select("page").join(best, F.col("page.row") == F.col("row"), "left")
    return out.select(
        "page.kept.*",
        "page.host",
        "page.path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def sweep(points: DataFrame, intervals: DataFrame, payload: str, deepest: bool) -> DataFrame:
    """``payload`` of each point with ``found``: the intervals that hold it, outermost first, or only the deepest.

    ``points``: h, p and the payload; ``intervals``: h, p, tag. An interval holds the points of its
    h whose p starts with its own."""
    spark = points.sparkSession
    kind = points.schema[payload].dataType
    salt = F.pmod(F.xxhash64(payload), F.lit(_SALTS)).cast("int")
    keys = points.select("h", F.substring("p", 1, CLIP).alias("p"), salt.alias("salt"))
    keys = keys.union(intervals.select("h", F.substring("p", 1, CLIP), F.lit(0)))
    cuts, n = _cut_points(keys)

    def deal_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = zip(batch.column("h").to_pylist(), batch.column("p").to_pylist(), batch.column("salt").to_pylist(), strict=True)
            found = [bisect_right(cuts, (h, p[:CLIP], s)) for h, p, s in at]
            yield batch.drop_columns(["salt"]).append_column("part", pa.array(found, pa.int32()))

    def deal_intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, part = [], []
            for i, (h, p) in enumerate(zip(batch.column("h").to_pylist(), batch.column("p").to_pylist(), strict=True)):
                p = p[:CLIP]
                k = bisect_right(cuts, (h, p, -1))
                which.append(i)
                part.append(k)
                while k < len(cuts) and cuts[k][0] == h and cuts[k][1].startswith(p):
                    k += 1
                    which.append(i)
                    part.append(k)
                if len(which) >= 10_000:
                    yield batch.take(pa.array(which)).append_column("part", pa.array(part, pa.int32()))
                    which, part = [], []
            yield batch.take(pa.array(which, pa.int64())).append_column("part", pa.array(part, pa.int32()))

    dealt = points.select("h", "p", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("tag"), payload, salt.alias("salt"))
    schema = f"h string, p string, kind int, tag string, {payload} {kind.simpleString()}, part int"
    dealt = dealt.mapInArrow(deal_points, schema)
    rules = intervals.select("h", "p", F.lit(0).alias("kind"), "tag", F.lit(None).cast(kind).alias(payload))
    dealt = dealt.union(rules.mapInArrow(deal_intervals, schema))
    ordered = dealt.repartitionById(n, F.col("part")).sortWithinPartitions("part", "h", "p", "kind")
    arrow = pa.list_(pa.struct([("p", pa.string()), ("tag", pa.string())]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, stack = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "h", "p", "kind", "tag")]
            which, found = [], []
            for i, (part, h, p, is_point, tag) in enumerate(zip(*columns, strict=True)):
                if (part, h) != place:
                    place, stack = (part, h), []
                while stack and not p.startswith(stack[-1]["p"]):
                    stack.pop()
                if is_point:
                    which.append(i)
                    found.append(stack[-1:] if deepest else stack[:])
                else:
                    stack.append({"p": p, "tag": tag})
            kept = batch.column(payload).take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept, pa.array(found, arrow)], [payload, "found"])

    return ordered.mapInArrow(merge, f"{payload} {kind.simpleString()}, found {_FOUND}")


def _cut_points(keys: DataFrame) -> tuple[list[tuple], int]:
    """Cut points of the key space and the number of ranges, from a sample of ``SAMPLE`` keys for each range."""
    total = keys.count()
    n = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // RANGE_ROWS)
    share = min(1.0, SAMPLE * n / max(total, 1))
    sample = sorted(tuple(r) for r in keys.sample(share, seed=11).collect())
    return [sample[i * len(sample) // n] for i in range(1, n)] if sample else [], n
