"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A row descends three levels: region, rack, shard. At each node every child
draws -ln(u) / weight, with u a uniform hash of (key, child's path), and the
least draw wins; a child's weight is the sum of the shards below it. A child's
draw depends on nothing but the key, its own path and its own weight, so a
change of weight moves rows only into or out of the subtrees whose weight
changed; the others keep theirs.

A tree grows by a region of its own for each new shard: rows move only into it.

Slots number the rows of a shard without gaps. The order is by a content hash;
its leading digits cut a shard into buckets, bucket totals are added up, and a
window numbers the rows inside one bucket. Equal rows are counted first and
numbered as one run, so no key makes a large bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 13  # hex digits of a draw: 52 bits, exact in a double


@dataclass(frozen=True)
class HashTree:
    """regions -> racks -> shards as nested tuples of (shard number, weight)."""
    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @staticmethod
    def regular(regions: int, racks: int, shards: int) -> HashTree:
        """Equal weights; shards numbered from 0 along the tree."""
        number = iter(range(regions * racks * shards))
        return HashTree(tuple(tuple(tuple((next(number), 1.0) for _ in range(shards)) for _ in range(racks))
                              for _ in range(regions)))

    @property
    def size(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def grown(self, weight: float = 1.0) -> HashTree:
        """One more shard, in a region and rack of its own."""
        return HashTree((*self.regions, (((self.size, weight),),)))

    def reweighted(self, shard: int, weight: float) -> HashTree:
        return HashTree(tuple(tuple(tuple((s, weight if s == shard else w) for s, w in rack) for rack in region)
                              for region in self.regions))


def _least(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """The value of the child with the least draw; the first of equal ones."""
    if len(children) == 1:
        return children[0][2]
    draws = []
    for i, (path, weight, value) in enumerate(children):
        bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(":" + path)).cast("binary")), 1, DIGITS), 16, 10).cast("double")
        draws.append(F.struct((-F.log((bits + 1) / float(1 << 4 * DIGITS)) / weight).alias("draw"), F.lit(i).alias("i"),
                              value.alias("value")))
    return F.array_min(F.array(*draws))["value"]


def _pick(at: Column, branches: list[Column]) -> Column:
    out = branches[-1]
    for i in range(len(branches) - 2, -1, -1):
        out = F.when(at == i, branches[i]).otherwise(out)
    return out


def with_shard(df: DataFrame, key: Column, tree: HashTree, name: str = "shard") -> DataFrame:
    """df with the shard of each row, from the key alone. A null key counts as an empty one."""
    key = F.coalesce(key.cast("string"), F.lit(""))
    weight = lambda rack: sum(w for _, w in rack)
    region = _least(key, [(f"{r}", sum(map(weight, racks)), F.lit(r)) for r, racks in enumerate(tree.regions)])
    df = df.withColumn("__region", region)
    rack = _pick(F.col("__region"), [_least(key, [(f"{r}/{k}", weight(rack), F.lit(k)) for k, rack in enumerate(racks)])
                                     for r, racks in enumerate(tree.regions)])
    df = df.withColumn("__rack", rack)
    shard = _pick(F.col("__region"), [
        _pick(F.col("__rack"), [_least(key, [(f"{r}/{k}/{s}", w, F.lit(s)) for s, w in rack]) for k, rack in enumerate(racks)])
        for r, racks in enumerate(tree.regions)])
    return df.withColumn(name, shard.cast("int")).drop("__region", "__rack")


def with_slots(rows: DataFrame, columns: list[str], shard: str = "shard", bucket_rows: int = 1 << 18,
               run_rows: int = 1 << 16) -> DataFrame:
    """rows (shard and the given columns) with slot: 0, 1, ... inside each shard, in order of a hash of the columns.

    Rows that are equal in all columns take adjacent slots. No bucket, and so
    no task, holds much more than bucket_rows distinct rows.
    """
    text = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    same = rows.groupBy(shard, *columns).agg(F.count("*").alias("__n")).withColumn("__h", F.md5(text.cast("binary")))
    n, digits = rows.count(), 0
    while n > bucket_rows * 16**digits and digits < 8:
        digits += 1
    same = same.withColumn("__b", F.substring("__h", 1, digits))
    totals = same.groupBy(shard, "__b").agg(F.sum("__n").alias("__t"))
    before = Window.partitionBy(shard).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col(shard).alias("__s"), F.col("__b").alias("__c"),
                          F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(shard, "__b").orderBy("__h", *columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = (same.join(bases, (F.col(shard) == F.col("__s")) & (F.col("__b") == F.col("__c")))
              .withColumn("__first", F.col("__base") + F.coalesce(F.sum("__n").over(inside), F.lit(0))))
    out = [shard, *columns]
    runs = placed.select(*out, "__first", "__n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1,
                                                                      F.lit(run_rows).cast("long"))).alias("__at"))
    size = F.least(F.col("__n") - F.col("__at"), F.lit(run_rows).cast("long"))
    one = runs.where(F.col("__n") <= run_rows)
    many = runs.where(F.col("__n") > run_rows).repartition(F.xxhash64(*columns, "__at"))  # long runs go to several tasks
    start = F.col("__first") + F.col("__at")
    spread = lambda d: d.select(*out, F.explode(F.sequence(start, start + size - 1)).alias("slot"))
    return spread(one).unionAll(spread(many))


def assign(docs: DataFrame, tree: HashTree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard): one row per input row; law `key`.

    size: UTF-8 bytes of the text plus 8 (null text: 8), text_crc32 of the UTF-8
    bytes (null text: 0). The shard depends on the id and the tree alone; a null
    id counts as an empty key. Empty table: no row.
    """
    raw = F.col(text_col).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.coalesce(F.octet_length(raw), F.lit(0)) + 8).cast("long").alias("size"),
                       F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"))
    placed = with_slots(with_shard(rows, F.col("doc_id"), tree), ["doc_id", "size", "text_crc32"])
    return with_shard(placed, F.col("doc_id"), tree.grown(), "grown_shard")


def oracle(tree: HashTree) -> str:
    """The same rows in DuckDB SQL, written level by level over the tree as a table."""
    def rows(t: HashTree) -> str:
        return ", ".join(f"({r}, {k}, {s}, {w})" for r, racks in enumerate(t.regions) for k, rack in enumerate(racks) for s, w in rack)

    def levels(name: str, values: str, out: str) -> str:
        draw = "-ln((('0x' || substr(md5(d.key || ':' || {p}), 1, 13))::BIGINT::DOUBLE + 1) / 4503599627370496.0) / {w}"
        return f"""
{name}(region, rack, shard, w) AS (VALUES {values}),
{name}1 AS (SELECT d.key, arg_min(t.region, ({draw.format(p="t.region", w="t.w")}, t.region)) AS region
  FROM keys d, (SELECT region, sum(w) AS w FROM {name} GROUP BY 1) t GROUP BY 1),
{name}2 AS (SELECT d.key, any_value(d.region) AS region, arg_min(t.rack, ({draw.format(p="t.region || '/' || t.rack", w="t.w")}, t.rack)) AS rack
  FROM {name}1 d JOIN (SELECT region, rack, sum(w) AS w FROM {name} GROUP BY 1, 2) t ON t.region = d.region GROUP BY 1),
{name}3 AS (SELECT d.key, arg_min(t.shard, ({draw.format(p="t.region || '/' || t.rack || '/' || t.shard", w="t.w")}, t.shard))::INTEGER AS {out}
  FROM {name}2 d JOIN {name} t ON t.region = d.region AND t.rack = d.rack GROUP BY 1)"""

    return f"""
WITH tab AS (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(n))),
texts AS (SELECT DISTINCT text FROM documents),
crcs AS (SELECT text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS crc FROM texts, tab),
rows AS (SELECT d.doc_id, coalesce(d.doc_id::VARCHAR, '') AS key, coalesce(octet_length(encode(d.text)), 0)::BIGINT + 8 AS size,
    c.crc AS text_crc32 FROM documents d JOIN crcs c ON d.text IS NOT DISTINCT FROM c.text),
keys AS (SELECT DISTINCT key FROM rows),{levels("now", rows(tree), "shard")},{levels("grow", rows(tree.grown()), "grown_shard")}
SELECT r.doc_id, r.size, r.text_crc32, 'key' AS law, n.shard,
  row_number() OVER (PARTITION BY n.shard ORDER BY md5(r.key || ':' || r.size || ':' || r.text_crc32), r.doc_id, r.size, r.text_crc32) - 1 AS slot,
  g.grown_shard
FROM rows r JOIN now3 n ON n.key = r.key JOIN grow3 g ON g.key = r.key"""
