"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size: start at
``offset``, go on by ``skip``, both hashes of the shard's name. The shards take turns, each
claiming the first free slot of its order, until no slot is free, so shares differ by one
slot at most and a change of the shard set moves few slots. The table (``table_size`` rows,
a parameter with an upper bound) is broadcast; a key's slot is its hash modulo the size.

Everything is a DataFrame or SQL function. Defined results: a NULL key is placed like the
empty text; equal keys go to one shard; an empty table gives an empty result; input columns
other than the key are not read by :func:`assign_shards` and stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm.tables import table

#: Size of the lookup table (prime) and its upper bound (the fill takes size^2 / 2 steps).
TABLE_SIZE = 2053
MAX_TABLE_SIZE = 10_007
N_SHARDS = 16


def hash60(c: Column) -> Column:
    """The first 60 bits of a text's MD5 as a BIGINT."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("bigint")


def lookup_table(spark: SparkSession, shards: list[str], table_size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard): the filled table. Shards take turns in name order."""
    if table_size > MAX_TABLE_SIZE or table_size < 2 or any(table_size % k == 0 for k in range(2, int(table_size**0.5) + 1)):
        raise ValueError(f"table_size must be a prime of at most {MAX_TABLE_SIZE}")
    names = sorted(set(shards))
    if not 0 < len(names) <= table_size:
        raise ValueError("between one shard and table_size shards")
    m = F.lit(table_size).cast("bigint")
    name = F.explode(F.array(*[F.lit(n) for n in names])).alias("name")
    one = spark.range(1).select(name).select(
        "name",
        (hash60(F.concat(F.lit("offset "), F.col("name"))) % m).alias("offset"),
        (hash60(F.concat(F.lit("skip "), F.col("name"))) % (m - 1) + 1).alias("skip"),
    )
    # The slot's rank in a shard's order is (slot - offset) / skip modulo the prime size;
    # 1 / skip = skip^(size - 2), by squaring.
    bits = [i for i in range(table_size.bit_length()) if (table_size - 2) >> i & 1]
    power, inverse = F.col("skip"), F.lit(1).cast("bigint")
    inverse = F.aggregate(
        F.sequence(F.lit(0), F.lit(table_size.bit_length() - 1)),
        F.struct(power.alias("b"), inverse.alias("r")),
        lambda a, k: F.struct((a["b"] * a["b"] % m).alias("b"), F.when(k.isin(bits), a["r"] * a["b"] % m).otherwise(a["r"]).alias("r")),
        lambda a: a["r"],
    )
    orders = one.select("name", "offset", inverse.alias("inverse")).agg(F.sort_array(F.collect_list(F.struct("name", "offset", "inverse"))).alias("shards"))
    slots = F.sequence(F.lit(0).cast("bigint"), m - 1)

    def turn(state: Column, t: Column) -> Column:
        shard = F.element_at("shards", (t % len(names) + 1).cast("int"))
        rank = lambda s: F.pmod((s - shard["offset"]) * shard["inverse"], m)
        best = F.array_min(F.transform(state["free"], lambda s: F.struct(rank(s).alias("rank"), s.alias("slot"))))["slot"]
        return F.struct(
            F.array_remove(state["free"], best).alias("free"),
            F.concat(state["taken"], F.array(F.struct(best.alias("slot"), shard["name"].alias("shard")))).alias("taken"),
        )

    nothing = F.array().cast("array<struct<slot:bigint,shard:string>>")
    filled = F.aggregate(slots, F.struct(slots.alias("free"), nothing.alias("taken")), turn, lambda s: s["taken"])
    return orders.select(F.explode(filled).alias("_s")).select(F.col("_s.slot").alias("slot"), F.col("_s.shard").alias("shard"))


def assign_shards(df: DataFrame, key: str | Column, lookup: DataFrame, table_size: int = TABLE_SIZE, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``df`` with the columns ``slot`` and ``shard`` put first. No shuffle: the lookup table
    (at most MAX_TABLE_SIZE rows) is broadcast. Input columns of those names stay too, so
    choose other names where they must not clash."""
    key = F.col(key) if isinstance(key, str) else key
    placed = df.select((hash60(F.coalesce(key.cast("string"), F.lit(""))) % table_size).alias("_slot"), F.struct("*").alias("_row"))
    out = placed.join(F.broadcast(lookup.select(F.col("slot").alias("_slot"), F.col("shard").alias("_shard"))), "_slot")
    return out.select(F.col("_slot").alias(slot), F.col("_shard").alias(shard), "_row.*")


def shard_names(n: int = N_SHARDS) -> list[str]:
    return [f"shard-{i:02d}" for i in range(n)]


def op1_lookup_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot and shard of every document, 16 shards over a table of 2053 slots."""
    documents = table(spark, sf_dir, "documents").select("doc_id")
    return assign_shards(documents, "doc_id", lookup_table(spark, shard_names())).select("doc_id", "slot", "shard")


OP1_SQL = f"""
WITH RECURSIVE shards AS (
  SELECT i AS turn, name,
         ('0x' || substr(md5('offset ' || name), 1, 15))::BIGINT % {TABLE_SIZE} AS first_slot,
         ('0x' || substr(md5('skip ' || name), 1, 15))::BIGINT % {TABLE_SIZE - 1} + 1 AS step
  FROM (SELECT i, printf('shard-%02d', i) AS name FROM range({N_SHARDS}) r(i))),
visits AS (
  SELECT turn, (first_slot + j * step) % {TABLE_SIZE} AS slot, j FROM shards, range({TABLE_SIZE}) v(j)),
ranks AS (SELECT turn, list(j ORDER BY slot) AS rank_of FROM visits GROUP BY turn),
fill AS (
  SELECT 0::BIGINT AS t, range({TABLE_SIZE}) AS free, NULL::BIGINT AS slot, NULL::BIGINT AS turn
  UNION ALL
  SELECT t + 1, list_filter(free, lambda s: s <> pick), pick, turn
  FROM (SELECT f.t, f.free, r.turn,
               list_min(list_transform(f.free, lambda s: r.rank_of[s + 1] * 65536 + s)) % 65536 AS pick
        FROM fill f JOIN ranks r ON r.turn = f.t % {N_SHARDS} WHERE len(f.free) > 0))
SELECT d.doc_id, f.slot, s.name AS shard
FROM documents d
JOIN fill f ON f.slot = ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 15))::BIGINT % {TABLE_SIZE}
JOIN shards s ON s.turn = f.turn
"""
