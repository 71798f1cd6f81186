"""Mixing sources to target weights by blocks of tokens.

The words of a source's documents, laid end to end in a pseudorandom order, are
packed into blocks of a fixed length.  A target size per source follows from
its weight, at most a given number of times its own size (the excess goes to
the others).  The slots of all output shards are dealt to the sources by a
pseudorandom permutation, so that every shard draws its source counts without
replacement and their totals meet the targets; a slot's place among its source's slots goes
through the source's own permutation to a block, and blocks are joined by
(source, index).  All of it is DataFrame operators.

Defined results: a null text has no words and a null source is a source, last
in order; documents without words are kept with nothing taken; equal ids count
as one stretch each; an empty table gives no rows.  Only the named columns are
read.  Results depend on the rows and the seed alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlake.llm.common import WORD, WORD_SQL, few, once, staged, tasks

#: Words in a block, and output shards.
BLOCK_WORDS = 64
SHARDS = 64
#: Slots listed by one row of the quota's runs.
RUN_SLOTS = 4096
#: Documents in a bin of the running sums, on average, and bins that are summed together.
BIN_ROWS = 1024
SHELF_BINS = 4096
#: Turns of the permutation.
TURNS = 7
SEED = 42


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _hashed(value: Column, salt: Column, turn: int) -> Column:
    return F.xxhash64(value, salt, F.lit(turn))


def permuted(df: DataFrame, name: str, index: Column, size: Column, salt: Column) -> DataFrame:
    """Add ``name``: the image of ``index`` under a pseudorandom permutation of 0 to size - 1.

    The largest power of two below the size goes through a Feistel turn, then
    all numbers move on by a pseudorandom step, so that the rest comes inside,
    and again.  What a turn leaves out is less than half, so little is left
    after all turns.  Every step is a bijection: nothing is walked or sorted.
    Steps are columns of their own, as each is used several times by the next.
    """
    x, bits, half, top, n, key = (F.col(f"__{c}") for c in ("x", "bits", "half", "top", "n", "key"))
    low = F.call_function("shiftleft", F.lit(1).cast("bigint"), half) - 1
    high = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits - half) - 1
    df = (
        df.withColumn("__x", index.cast("bigint"))
        .withColumn("__n", size.cast("bigint"))
        .withColumn("__key", salt.cast("bigint"))
        .withColumn("__bits", F.length(F.bin("__n")) - 1)
        .withColumn("__half", F.floor(bits / 2).cast("int"))
        .withColumn("__top", F.call_function("shiftleft", F.lit(1).cast("bigint"), bits))
    )
    for turn in range(TURNS):
        upper = F.call_function("shiftleft", _hashed(x.bitwiseAND(low), key, 2 * turn).bitwiseAND(high), half)
        df = df.withColumn("__x", F.when(x < top, x.bitwiseXOR(upper)).otherwise(x))
        lower = _hashed(F.call_function("shiftright", x, half), key, 2 * turn + 1).bitwiseAND(low)
        df = df.withColumn("__x", F.when(x < top, x.bitwiseXOR(lower)).otherwise(x))
        df = df.withColumn("__x", F.pmod(x + F.pmod(_hashed(n, key, 2 * TURNS + turn), n), n))
    return df.withColumn(name, x).drop("__x", "__bits", "__half", "__top", "__n", "__key")


def targets(sizes: DataFrame, weights: tuple[int, ...], total_times: float, most_times: int) -> DataFrame:
    """(source, source_size) with ``number`` in code point order and ``target``.

    Targets share total_times x all sizes by weight and stop at most_times the
    source's own size, the excess going to the others.  Sources reach their
    stop in order of size per weight, so what is left for the rest follows from
    running sums.  There is one row per source.
    """
    scale = 1
    for w in weights:
        scale *= w
    turn = F.col("number") % F.lit(len(weights))
    ordered = (
        sizes.withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", F.get(F.array(*[F.lit(w).cast("bigint") for w in weights]), turn))
        .withColumn("ratio", F.col("source_size") * F.get(F.array(*[F.lit(scale // w) for w in weights]), turn))
    )
    whole = Window.partitionBy()
    before = Window.orderBy("ratio", "number").rowsBetween(Window.unboundedPreceding, -1)
    level = (
        ordered.withColumn("full", F.col("source_size") * most_times)
        .withColumn(
            "left",
            F.sum("source_size").over(whole) * F.lit(float(total_times))
            - F.coalesce(F.sum("full").over(before), F.lit(0)),
        )
        .withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("stopped", F.col("left") * F.col("weight") >= F.col("full") * F.col("weight_left"))
    )
    # The first source that is not stopped holds what is left for all such sources.
    rest = F.min(
        F.when(~F.col("stopped"), F.struct("ratio", "number", "left", "weight_left"))
    ).over(whole)
    target = F.when(F.col("stopped"), F.col("full").cast("double")).otherwise(
        F.col("weight") * rest["left"] / rest["weight_left"]
    )
    return level.withColumn("target", target).select("source", "source_size", "number", "weight", "target")


def packed(docs: DataFrame) -> DataFrame:
    """(key, number, size) plus ``start``: its first word's place in the source's stream.

    The stream follows a pseudorandom bin per document, then its key.  The bin
    is taken from id and text, so rows that share an id, or have none, are
    spread like others.  Sums are taken per (source, bin) and run over the bins
    of a shelf and over the shelves, so neither a source with a third of all
    rows nor the number of bins makes a task large.
    """
    n_bins = max(1, docs.count() // BIN_ROWS)
    place = F.pmod(F.xxhash64("doc_id", "digest", F.lit(SEED)), F.lit(n_bins))
    binned = docs.withColumn("bin", place).withColumn("shelf", F.floor(F.col("bin") / SHELF_BINS))

    def run_up(rows: DataFrame, within: list[str], by: str) -> DataFrame:
        """``words`` of the rows before, as ``<by>_start``."""
        before = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(f"{by}_start", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")

    words = binned.groupBy("number", "shelf", "bin").agg(F.sum("size").alias("words"))
    bins = run_up(words, ["number", "shelf"], "bin")
    shelves = run_up(words.groupBy("number", "shelf").agg(F.sum("words").alias("words")), ["number"], "shelf")
    starts = bins.join(shelves, ["number", "shelf"]).select(
        "number", "bin", (F.col("shelf_start") + F.col("bin_start")).alias("bin_start")
    )
    inside = (
        Window.partitionBy("number", "bin")
        .orderBy("doc_id", "digest", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = binned.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return placed.join(starts, ["number", "bin"]).select(
        *docs.columns, (F.col("bin_start") + F.col("inside")).alias("start")
    )


def quotas(goals: DataFrame, block: int) -> DataFrame:
    """Per source: its blocks, the slots to fill, and the slots of the sources before it."""
    order = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    # Counted in blocks, of which the last one of a source may be short.
    slots = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * F.col("blocks")))
    return (
        goals.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("bigint"))
        .withColumn("slots", F.coalesce(slots, F.lit(0)).cast("bigint"))
        .withColumn("first", F.coalesce(F.sum("slots").over(order), F.lit(0)))
    )


def drawn(quota: DataFrame, shards: int, seed: int) -> DataFrame:
    """One row per slot: its shard and place, source number, pass and block index.

    All slots of all sources are numbered in a row; a pseudorandom permutation
    of these numbers deals them to the places of the shards, so each shard
    draws its source counts without replacement from the quotas.  A slot's
    place among its source's slots goes through the permutation of that source
    and pass to a block.
    """
    spark = quota.sparkSession
    total = quota.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    per_shard = max(1, -(-total // shards))
    runs = quota.where("slots > 0").select(
        "number", "blocks", "first", "slots", F.explode(F.expr(f"sequence(0L, slots - 1, {RUN_SLOTS}L)")).alias("run")
    )
    # A source's slots are listed run by run, so that a large one is spread out.
    slots = runs.repartition(tasks(spark), "number", "run").select(
        "number",
        "blocks",
        "first",
        F.explode(F.sequence("run", F.least(F.col("run") + RUN_SLOTS, F.col("slots")) - 1)).alias("of_source"),
    )
    passed = F.floor(F.col("of_source") / F.col("blocks"))
    slots = permuted(slots, "place", F.col("first") + F.col("of_source"), F.lit(max(1, total)), F.lit(seed))
    slots = permuted(
        slots.withColumn("pass", passed.cast("int")),
        "block",
        F.col("of_source") % F.col("blocks"),
        F.col("blocks"),
        F.lit(seed) + F.col("number") * 31 + F.col("pass") * 17 + 1,
    )
    # Written, so that no later filter is pushed down into the chained steps.
    return staged(
        slots.select("number", "block", "pass", F.floor(F.col("place") / per_shard).cast("int").alias("shard"), "place"),
        "mix-slots",
    )


def sized(docs: DataFrame) -> DataFrame:
    """The narrow table that mixing works on: ids, sources and numbers of words."""
    return staged(
        docs.select(
            "doc_id", F.xxhash64("text").alias("digest"), "source", n_words(F.col("text")).alias("size")
        ),
        "mix-sizes",
    )


def mixed_pieces(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    total_times: float = 1.5,
    most_times: int = 2,
    block: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(goals, documents, pieces) of the mix of ``sized`` documents.

    A piece is the part of a document that lies in one block: first word,
    number of words and the slots (pass, shard, place) that take the block.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = staged(targets(sizes, weights, total_times, most_times), "mix-goals")
    numbered = docs.join(
        few(goals.select(F.col("source").alias("s"), "source_size", "number", "target")),
        F.col("source").eqNullSafe(F.col("s")),
    ).drop("s")
    placed = packed(numbered)
    slots = drawn(quotas(goals, block), shards, seed)
    taken = slots.groupBy("number", "block").agg(
        F.array_sort(F.collect_list(F.struct("pass", "shard", "place"))).alias("slots")
    )
    last = F.col("start") + F.col("size") - 1
    parts = (
        placed.where("size > 0")
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor(last / block))))
        .withColumn("word", F.greatest(F.col("block") * block - F.col("start"), F.lit(0)))
        .withColumn("words", F.least((F.col("block") + 1) * block - F.col("start"), F.col("size")) - F.col("word"))
    )
    # A block has at most most_times slots, one per pass.
    pieces = parts.join(taken, ["number", "block"], "left")
    return goals, numbered, pieces


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target and the words that the mix takes."""
    _, numbered, pieces = mixed_pieces(sized(docs), **options)
    times = F.coalesce(F.size("slots"), F.lit(0))
    taken = pieces.groupBy("number", "start", "doc_id", "size", "source_size", "target").agg(
        F.sum(F.col("words") * F.greatest(times, F.lit(0))).alias("taken")
    )
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    return taken.select(columns).unionByName(
        numbered.where("size = 0").withColumn("taken", F.lit(0).cast("bigint")).select(columns)
    )


def _numbered(docs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Add the keys of the pieces, and ``__copy``: 1, 2 and so on over rows of one id, text and source."""
    key = ["__id", "__digest", "__source"]
    repeated = staged(
        sizes.groupBy(F.col("doc_id").alias("__i"), F.col("digest").alias("__d"), F.col("source").alias("__s"))
        .count()
        .where("count > 1")
        .drop("count"),
        "mix-repeats",
    )
    keyed = docs.select(
        "*", F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__digest"), F.col("source").alias("__source")
    )
    if repeated.isEmpty():
        return keyed.withColumn("__copy", F.lit(1))
    repeated = few(repeated)
    same = (
        F.col("__id").eqNullSafe(F.col("__i"))
        & (F.col("__digest") == F.col("__d"))
        & F.col("__source").eqNullSafe(F.col("__s"))
    )
    single = keyed.join(repeated, same, "left_anti").withColumn("__copy", F.lit(1))
    others = F.xxhash64(F.lit(0), *[f"`{c}`" for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"])
    copies = F.row_number().over(Window.partitionBy(*key).orderBy(others))
    return single.unionByName(keyed.join(repeated, same, "left_semi").withColumn("__copy", copies))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The taken words of each document as its text, whole passes one after the other.

    Documents of which nothing is taken go; words are joined by one space; the
    other columns stay and n_chars is counted anew.  Of rows of one id, text and
    source each has its own pieces.
    """
    sizes = sized(docs)
    _, _, pieces = mixed_pieces(sizes, **options)
    key = ["doc_id", "digest", "source"]
    parts = (
        pieces.where(F.col("slots").isNotNull())
        .withColumn("slot", F.explode("slots"))
        .groupBy(*key, "start")
        .agg(F.array_sort(F.collect_list(F.struct("slot.pass", "word", "words"))).alias("__parts"))
        .withColumn("__place", F.row_number().over(Window.partitionBy(*key).orderBy("start")))
        .select(F.col("doc_id").alias("__i"), F.col("digest").alias("__d"), F.col("source").alias("__s"), "__place", "__parts")
    )
    words = F.expr(f"regexp_extract_all(text, '{WORD_SQL}', 0)")
    text = F.array_join(
        F.flatten(
            F.transform(
                "__parts",
                lambda p: F.slice(F.col("__words"), (p["word"] + 1).cast("int"), p["words"].cast("int")),
            )
        ),
        " ",
    )
    joined = _numbered(docs, sizes).join(
        parts,
        F.col("__id").eqNullSafe(F.col("__i"))
        & (F.col("__digest") == F.col("__d"))
        & F.col("__source").eqNullSafe(F.col("__s"))
        & (F.col("__copy") == F.col("__place")),
    )
    return (
        joined.select("*", once(words, "__words"))
        .withColumn("text", text)
        .withColumn("n_chars", F.length("text").cast("bigint"))
        .select(*docs.columns)
    )
