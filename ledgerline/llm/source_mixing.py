"""Mixing sources to target weights by Sainte-Laguë apportionment (native).

Each source's words are cut into blocks of equal word counts. Highest
quotients give every source its number of blocks, and a second apportionment
gives every shard of a source an integer quota. Within a shard the documents
stand in a seeded order, blocks are counted along that order, and the quota
takes whole passes over the shard plus one seeded, cyclic run of blocks. The
words taken from a document follow in closed form from its place in the order,
so no block is ever materialised.

A source is dealt over about sqrt(documents) shards: a source with a third of
all rows is split over as many tasks, and the table of its shards stays as
small as one shard. Everything here is DataFrame functions; no Python runs on
the executors.

Defined results: null text has size 0 and takes nothing; null source is a
source of its own, ranked last; repeated rows count once each; an empty table
gives an empty result; a null id is an id of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD_CLASS, stored, text_of, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5        # of all words
MAX_REPEATS = 2    # passes over one source, and over one document
BLOCK_WORDS = 4    # costs nothing: blocks are never materialised
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE,
                   max_repeats=MAX_REPEATS) -> DataFrame:
    """Per source: rank, words, n_docs, target. Weights repeat in code point
    order of the source, null last. A target above ``max_repeats`` times the
    source's words stops there and the excess is shared again by weight: the
    capped sources are a prefix in order of words per weight, so one running
    sum finds them. The windows run over the table of sources alone."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n_docs"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    src = src.withColumn("rank", F.row_number().over(by_name) - 1)
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("rank") % len(weights) + 1)
    src = src.withColumn("weight", pick.cast("long")).withColumn("cap", F.col("words") * max_repeats)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    src = (src.withColumn("total", F.sum("words").over(every) * F.lit(float(share)))
           .withColumn("all_weight", F.sum("weight").over(every))
           .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
           .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0))))
    level = (F.col("total") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before"))
    src = src.withColumn("capped", F.col("cap") / F.col("weight") <= level)
    src = (src.withColumn("cap_sum", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(every))
           .withColumn("cap_weight", F.sum(F.when(F.col("capped"), F.col("weight")).otherwise(0)).over(every)))
    free = F.col("weight") * (F.col("total") - F.col("cap_sum")) / (F.col("all_weight") - F.col("cap_weight"))
    return src.select("source", "rank", "words", "n_docs",
                      F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(free).alias("target"))


def sainte_lague(items: DataFrame, group: str, item: str) -> DataFrame:
    """Adds ``quota`` to rows (group, item, weight, seats, cap): the seats of a
    group go to the highest quotients weight / (2k + 1).

    Rounding weight / (group weight / seats) to the nearest integer is right
    but for ``diff`` seats, at most half as many as the group has items, so
    only that many next (or last) seats of each item compete by quotient."""
    g = Window.partitionBy(group)
    share = F.col("weight") * F.col("seats") / F.sum("weight").over(g)
    items = items.withColumn("base", F.least(F.floor(F.coalesce(share, F.lit(0.0)) + 0.5), F.col("cap")).cast("long"))
    items = items.withColumn("diff", (F.col("seats") - F.sum("base").over(g)).cast("long"))
    more = F.least(F.col("base") + F.col("diff"), F.col("cap")) - 1
    less = F.greatest(F.col("base") + F.col("diff"), F.lit(0))
    seats = (F.when((F.col("diff") > 0) & (more >= F.col("base")), F.sequence(F.col("base"), more))
             .when((F.col("diff") < 0) & (F.col("base") > less), F.sequence(less, F.col("base") - 1)))
    open_ = (items.where("diff != 0").select(group, item, "diff", "weight", F.explode(seats).alias("k"))
             .withColumn("quotient", F.col("weight") / (2 * F.col("k") + 1)))
    # Added seats: highest first. Seats given back: lowest first.
    up, order_item = F.col("diff") > 0, F.when(F.col("diff") > 0, F.col(item)).otherwise(-F.col(item))
    order = Window.partitionBy(group).orderBy(F.when(up, -F.col("quotient")).otherwise(F.col("quotient")),
                                              order_item, F.when(up, F.col("k")).otherwise(-F.col("k")))
    won = (open_.withColumn("place", F.row_number().over(order)).where(F.col("place") <= F.abs("diff"))
           .groupBy(group, item).agg(F.sum(F.signum("diff")).cast("long").alias("change")))
    return (items.join(won, [group, item], "left")
            .withColumn("quota", F.col("base") + F.coalesce("change", F.lit(0)))
            .drop("base", "diff", "change"))


def _digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(SEED), *parts).cast("binary"))


def _number(digest: Column, digits: int = 12) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def _placed(df: DataFrame, id_col: str, text_col: str, source_col: str, weights, share, max_repeats: int,
            block_words: int, carry: bool) -> DataFrame:
    """Per input row: id, size, source_size, target, passes (whole takes), and
    the words [run_from, run_to) and [0, wrap_to) that are taken once more."""
    text, source = text_of(text_col), F.col(source_col).cast("string")
    rows = df.select(F.col(id_col).alias("id"), source.alias("source"), word_count(text).alias("size"),
                     F.md5(text.cast("binary")).alias("text_hash"), *([F.struct("*").alias("row")] if carry else []))
    sizes = rows.select("id", "source", "size", "text_hash")
    sizes = stored(sizes, "mix-sizes")
    rows = rows if carry else sizes
    # The table of sources: one row each, small next to the documents and read often.
    sources = stored(source_targets(sizes, weights, share, max_repeats), "mix-sources")
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    quotas = sources.withColumns({"one": F.lit(1), "weight": F.col("target"),
                                  "seats": F.floor(F.sum("target").over(every) / block_words + 0.5),
                                  "cap": (F.ceil(F.col("words") / block_words) * max_repeats).cast("long")})
    quotas = stored(sainte_lague(quotas, "one", "rank").select(
        F.col("source").alias("of_source"), "rank", F.col("words").alias("source_size"), "target",
        F.col("quota").alias("source_quota"), F.ceil(F.sqrt("n_docs")).cast("long").alias("n_shards")), "mix-quotas")

    def dealt(frame: DataFrame) -> DataFrame:
        key = F.coalesce(F.col("id").cast("string"), F.lit(""))
        frame = frame.join(quotas, F.col("source").eqNullSafe(F.col("of_source"))).withColumn("place", _digest(key, F.col("text_hash")))
        return frame.withColumn("shard", F.pmod(_number(F.col("place")), F.col("n_shards")))

    shards = (dealt(sizes).groupBy("rank", "shard").agg(F.sum("size").alias("weight"), F.first("source_quota").alias("seats"))
              .withColumn("cap", (F.ceil(F.col("weight") / block_words) * max_repeats).cast("long")))
    m = F.greatest(F.ceil(F.col("weight") / block_words), F.lit(1)).cast("long")
    shards = sainte_lague(shards, "rank", "shard").select("rank", "shard", "quota", m.alias("m"))
    order = (Window.partitionBy("rank", "shard").orderBy("place", "id", "size", "text_hash")
             .rowsBetween(Window.unboundedPreceding, 0))
    placed = dealt(rows).withColumn("end", F.sum("size").over(order)).join(shards, ["rank", "shard"])
    placed = (placed.withColumn("start", F.col("end") - F.col("size"))
              .withColumn("passes", F.floor(F.col("quota") / F.col("m")).cast("long"))
              .withColumn("extra", F.pmod("quota", "m"))
              .withColumn("first", F.pmod(_number(_digest(F.col("rank").cast("string"), F.col("shard").cast("string"))),
                                          F.col("m"))))
    last = F.col("first") + F.col("extra")

    def inside(place: Column) -> Column:
        """A place along the shard as one in the document."""
        return F.least(F.greatest(place - F.col("start"), F.lit(0)), F.col("size")).cast("long")

    return placed.select(
        "id", "size", "source_size", "target", "passes", inside(F.col("first") * block_words).alias("run_from"),
        inside(F.least(last, F.col("m")) * block_words).alias("run_to"),
        inside(F.greatest(last - F.col("m"), F.lit(0)) * block_words).alias("wrap_to"), *(["row"] if carry else []))


def mix_sources(df: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS,
                share=SHARE, max_repeats=MAX_REPEATS, block_words=BLOCK_WORDS) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken."""
    out = _placed(df, id_col, text_col, source_col, weights, share, max_repeats, block_words, carry=False)
    taken = F.col("passes") * F.col("size") + F.col("run_to") - F.col("run_from") + F.col("wrap_to")
    return out.select("id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_rows(df: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS,
               share=SHARE, max_repeats=MAX_REPEATS, block_words=BLOCK_WORDS, chars_col="n_chars") -> DataFrame:
    """The mix itself, with the columns of ``df``: a row per whole take of a
    document, and one per part taken once more (its words, joined by spaces; at
    most two documents of a shard are cut). A document that gives no words goes."""
    out = _placed(df, id_col, text_col, source_col, weights, share, max_repeats, block_words, carry=True)
    whole = F.transform(F.sequence(F.lit(1).cast("long"), F.col("passes")),
                        lambda _: F.struct(F.lit(0).cast("long").alias("a"), F.col("size").alias("b")))
    parts = F.concat(F.when(F.col("passes") > 0, whole).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>")),
                     F.array(F.struct(F.col("run_from").alias("a"), F.col("run_to").alias("b")),
                             F.struct(F.lit(0).cast("long").alias("a"), F.col("wrap_to").alias("b"))))
    out = out.select("row", "size", F.explode(F.filter(parts, lambda p: p["b"] > p["a"])).alias("part"))
    words = F.regexp_extract_all(F.col("row")[text_col], F.lit(WORD_CLASS), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("part.a") + 1).cast("int"), (F.col("part.b") - F.col("part.a")).cast("int")), " ")
    is_cut = F.col("part.b") - F.col("part.a") < F.col("size")
    row = F.col("row")
    columns = {c: row[c] for c in df.columns}
    columns[text_col] = F.when(is_cut, cut).otherwise(row[text_col])
    if chars_col in columns:
        columns[chars_col] = F.when(is_cut, F.char_length(cut).cast("long")).otherwise(row[chars_col])
    return out.select(*[v.alias(c) for c, v in columns.items()])
