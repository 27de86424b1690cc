"""Benchmark decontamination by SimHash windows, in DataFrame operations only.

Documents are compared with benchmark items in windows of an item's own number of words. A
window's SimHash meets the items' through multi-index Hamming blocks (a radius of r and r + 1
blocks: two fingerprints within the radius agree on one block at least), and the weighted
shingle similarity decides.

Windows are not taken at every word. A window that is similar enough shares all but a known
number of an item's word occurrences with it; so of any larger number of the item's rarest
occurrences some stand in the window. Where they stand in it does not matter, as the similarity
does not look at the order of shingles either.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightmill.llm.common import cut, measured, scratch_names, words

BITS = 64
LANES = 2
LANE_BITS = BITS // LANES
LANE_MASK = 0x0000000100000001
LANE_FULL = (1 << LANE_BITS) - 1
#: Rare occurrences that a window must hold at least, where an item is long enough.
SUPPORT = 3


def shingle_list(tokens: Column, n: int) -> Column:
    """All n-word shingles in order; a shorter non-empty sequence is one shingle."""
    return (
        F.when(
            F.size(tokens) >= n,
            F.transform(
                F.sequence(F.lit(1), F.size(tokens) - (n - 1)),
                lambda i: F.concat_ws(" ", F.slice(tokens, i, F.lit(n))),
            ),
        )
        .when(F.size(tokens) > 0, F.array(F.concat_ws(" ", tokens)))
        .otherwise(F.array().cast("array<string>"))
    )


def _with_marks(frame: DataFrame, tokens: str, name: str, n: int) -> DataFrame:
    """Add the weighted shingles of ``tokens``: numbered by occurrence, "the 2", so that set
    operations count multiplicities.

    Sorted, equal shingles stand in runs, and each run is numbered from 1: no search for earlier
    occurrences. Shingles and the starts of their runs are columns of their own, or they would be
    made anew for every run.
    """
    listed, starts = scratch_names(frame, "shingles", "starts")
    sorted_ = frame.withColumn(listed, F.array_sort(shingle_list(F.col(tokens), n)))
    s = F.col(listed)
    runs = sorted_.withColumn(
        starts,
        F.when(F.size(s) == 0, F.array().cast("array<int>")).otherwise(
            F.filter(
                F.sequence(F.lit(0), F.size(s) - 1),
                lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
            )
        ),
    )

    def numbered(start: Column, k: Column) -> Column:
        after = F.coalesce(F.get(F.col(starts), k + 1), F.size(s))
        return F.transform(
            F.sequence(F.lit(1), after - start), lambda t: F.concat_ws(" ", F.get(s, start), t)
        )

    return runs.withColumn(name, F.flatten(F.transform(starts, numbered))).drop(listed, starts)


def with_simhash(frame: DataFrame, tokens: str, name: str) -> DataFrame:
    """Add the 64-bit SimHash of a word multiset: bit by bit, what more than half of them have.

    Two counters share one long, so 32 running sums serve 64 bits, and a counter of 32 bits
    holds any array's size. Hashes and sums are columns of their own, or every sum would hash
    the words and every bit would sum them again.
    """
    hashes, sums = scratch_names(frame, "hashes", "sums")
    hashed = frame.withColumn(hashes, F.transform(tokens, lambda w: F.xxhash64(w)))
    counted = hashed.withColumn(
        sums,
        F.expr(
            f"transform(sequence(0, {LANE_BITS - 1}), s -> aggregate(`{hashes}`, 0L, "
            f"(n, h) -> n + (shiftrightunsigned(h, s) & {LANE_MASK}L)))"
        ),
    )
    half = F.size(hashes).cast("long")
    bits = []
    for place in range(BITS):
        lane, shift = divmod(place, LANE_BITS)
        total = F.col(sums)[shift]
        count = F.shiftrightunsigned(total, lane * LANE_BITS).bitwiseAND(F.lit(LANE_FULL))
        value = 1 << place if place < BITS - 1 else -(1 << place)
        bits.append(F.when(count * 2 > half, F.lit(value)).otherwise(F.lit(0)).cast("long"))
    return counted.withColumn(name, reduce(lambda a, b: a.bitwiseOR(b), bits)).drop(hashes, sums)


def hamming_blocks(fingerprint: Column, radius: int) -> Column:
    """radius + 1 keys (block number and bits); within the radius one of them is equal."""
    blocks = radius + 1
    keys = []
    for k in range(blocks):
        low, high = BITS * k // blocks, BITS * (k + 1) // blocks
        part = F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        keys.append(part * F.lit(blocks) + F.lit(k))
    return F.array(*keys)


def _profiles(items: DataFrame, text: str, id_column: str, n: int, similarity: float) -> DataFrame:
    """Items that have words: words, their number, and how many occurrences may be missing.

    ``item`` tells them apart, a digest of id and words: ids may be NULL or stand for many texts.
    """
    tokens = items.select(
        F.col(f"`{id_column}`").alias("item_id"), words(F.col(f"`{text}`")).alias("item_words")
    ).distinct()
    size = F.size("item_words")
    shingles = F.greatest(size - (n - 1), F.lit(1))
    # Not below the exact value: a rounding error must not lose a window.
    missing = F.floor(shingles * (1 - similarity) + 1e-9).cast("int")
    return tokens.where(size > 0).select(
        # NULL ids are left out of the JSON text, so they differ from any other id.
        F.md5(F.to_json(F.struct("item_id", "item_words")).cast("binary")).alias("item"),
        "item_id",
        "item_words",
        size.alias("w"),
        missing.alias("missing"),
        F.least(F.lit(SUPPORT), size - missing).alias("support"),
    )


def _rare_occurrences(profiles: DataFrame, doc_words: DataFrame) -> DataFrame:
    """(item, w, support, word, mark, weight) of each item's rarest occurrences.

    Rare is what the documents hold seldom. ``weight`` counts the occurrences of a word among
    them, ``mark`` is a number of the word within the item.
    """
    placed = profiles.select("item", "w", "missing", "support", F.posexplode("item_words"))
    placed = placed.withColumnsRenamed({"pos": "q", "col": "word"})
    vocabulary = measured(placed.select(F.col("word").alias("known")).distinct())
    # Counted before the join, so that a frequent word is one row in each map task.
    counts = (
        doc_words.select(F.explode("words").alias("counted"))
        .groupBy("counted")
        .count()
        .join(vocabulary, F.col("counted") == F.col("known"), "left_semi")
    )
    ranked = (
        placed.join(counts, F.col("word") == F.col("counted"), "left")
        .select(
            "item", "w", "missing", "support",
            F.struct(F.coalesce("count", F.lit(0)).alias("n"), "word", "q").alias("at"),
        )
        .groupBy("item", "w", "missing", "support")
        .agg(F.sort_array(F.collect_list("at")).alias("order"))
    )
    # missing + support occurrences: of these at least ``support`` stand in a similar window.
    taken = ranked.select(
        "item",
        "w",
        "support",
        F.explode(F.slice("order", F.lit(1), F.col("missing") + F.col("support"))).alias("at"),
    )
    return taken.groupBy("item", "w", "support", F.col("at.word").alias("word")).agg(
        F.min("at.q").alias("mark"), F.count("*").alias("weight")
    )


def _weight(hits: Column) -> Column:
    """Rare occurrences that the words among ``hits`` stand for, each word counted once."""
    found = F.array_distinct(F.transform(hits, lambda h: F.struct(h["mark"], h["weight"])))
    return F.aggregate(found, F.lit(0).cast("long"), lambda total, x: total + x["weight"])


def contaminated_windows(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    item_text: str = "text",
    item_id_column: str = "item_id",
    n: int = 5,
    similarity: float = 0.8,
    radius: int = 20,
) -> DataFrame:
    """Best match of each document and item: key, doc id, item_id, similarity, start, n_words.

    Similarity: sum of minima over sum of maxima of the multiplicities of n-word shingles (a
    shorter text is one shingle) between the item and a window of as many words, or the whole
    document where that is shorter. ``start`` counts words from 0; of equal windows the first
    counts. Words are lower-cased (A-Z) and split at blanks. NULL, empty and blank texts match
    nothing, on either side. Rows that repeat an id and text give one result; equal ids with
    other texts are told apart by ``key``. Items are told apart by id and words: an id with two
    texts gives a result for each that is found, and a NULL id is an id like any other. Other
    columns are not read. Items may be of any length, but where one is found, about 0.4 windows
    of its own size are compared for each of its words. The benchmark's words and the candidates
    are broadcast after a check of their size, and joined by shuffles beyond it.
    """
    profiles = _profiles(items, item_text, item_id_column, n, similarity)
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.col(f"`{id_column}`").cast("string"), raw).cast("binary"))
    source = docs.select(
        key.alias("key"), F.col(f"`{id_column}`").alias(id_column), words(raw).alias("words")
    )
    rare = measured(_rare_occurrences(profiles, source))
    hits = (
        source.select("key", F.posexplode("words").alias("p", "found"))
        .join(rare, F.col("found") == F.col("word"))
        .select("key", "item", "w", "support", F.struct("p", "mark", "weight").alias("hit"))
    )
    # A window that starts in stretch b of w words ends in stretch b + 1 at the latest.
    stretch = F.floor(F.col("hit.p") / F.col("w"))
    candidates = measured(
        hits.withColumn("stretch", F.explode(F.array(stretch, stretch - 1)))
        .where("stretch >= 0")
        .groupBy("key", "item", "support", "stretch")
        .agg(F.collect_list("hit").alias("hits"))
        .where(_weight(F.col("hits")) >= F.col("support"))
        .join(profiles.drop("support", "item_id"), "item")
        .select(
            F.col("key").alias("hit_key"), "item", "item_words", "w", "missing", "support", "hits",
            (F.col("stretch") * F.col("w")).cast("int").alias("low"),
        )
    )
    texts = candidates.join(source, F.col("hit_key") == F.col("key"))
    last = F.greatest(F.size("words") - F.col("w"), F.lit(0))
    # Of an item's different words no more than ``missing`` may be absent from a window, nor
    # from the two stretches that hold it.
    enough = F.size(F.array_distinct("item_words")) - F.col("missing")
    around = F.slice("words", F.col("low") + 1, 2 * F.col("w"))
    texts = texts.where(F.col("low") <= last).where(
        F.size(F.array_intersect(F.col("item_words"), around)) >= enough
    )
    starts = F.filter(
        F.sequence(F.col("low"), F.least(F.col("low") + F.col("w") - 1, last)),
        lambda s: _weight(
            F.filter("hits", lambda h: (h["p"] >= s) & (h["p"] < s + F.col("w")))
        ) >= F.col("support"),
    )
    cut_out = F.transform(
        starts,
        lambda s: F.struct(s.alias("start"), F.slice("words", s + 1, F.col("w")).alias("tokens")),
    )
    full = F.filter(
        cut_out, lambda x: F.size(F.array_intersect(F.col("item_words"), x["tokens"])) >= enough
    )
    # A window belongs to the item whose rare words it holds; a window that is similar to some
    # other item holds enough of that one's rare words, too, and is cut out for it as well.
    windows = (
        texts.select("key", id_column, "item", F.explode(full).alias("window"))
        .select("key", id_column, "item", "window.start", "window.tokens")
        .distinct()
    )
    windows = cut(with_simhash(windows, "tokens", "print"))
    item_prints = profiles.select(F.col("item").alias("of"), "item_id", "item_words")
    item_prints = with_simhash(item_prints, "item_words", "item_print")
    item_prints = cut(_with_marks(item_prints, "item_words", "theirs", n).drop("item_words"))
    # Fingerprints meet block by block; words and shingles stay behind until they are near.
    window_blocks = windows.select(
        "key", "item", "start", "print",
        F.explode(hamming_blocks(F.col("print"), radius)).alias("block"),
    )
    item_blocks = item_prints.select(
        "of", "item_print",
        F.explode(hamming_blocks(F.col("item_print"), radius)).alias("item_block"),
    )
    near = (
        window_blocks.join(
            item_blocks, (F.col("item") == F.col("of")) & (F.col("block") == F.col("item_block"))
        )
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        .select("key", "item", "start")
    )
    # Some pairs agree on many blocks; the semi join passes each on once.
    near = windows.drop("print").join(near, ["key", "item", "start"], "left_semi")
    near = _with_marks(near.withColumn("n_words", F.size("tokens")), "tokens", "mine", n)
    near = near.drop("tokens").join(item_prints, F.col("item") == F.col("of"))
    # The similarity is a column of its own, or the filter and the result would compute it twice.
    common = near.withColumn("common", F.size(F.array_intersect("mine", "theirs")))
    total = F.size("mine") + F.size("theirs") - F.col("common")
    return (
        common.withColumn("similarity", (F.col("common") / total).cast("double"))
        .where(F.col("similarity") >= similarity)
        .groupBy("key", id_column, "item", "item_id")
        .agg(
            F.max_by(
                F.struct("similarity", "start", "n_words"),
                F.struct("similarity", -F.col("start")),
            ).alias("best")
        )
        .select("key", id_column, "item_id", "best.similarity", "best.start", "best.n_words")
    )


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    **settings,
) -> DataFrame:
    """The rows of ``docs`` without any match, all columns as they are."""
    (key,) = scratch_names(docs, "key")
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    found = contaminated_windows(docs, items, text, id_column, **settings)
    marked = docs.withColumn(
        key, F.md5(F.concat_ws(":", F.col(f"`{id_column}`").cast("string"), raw).cast("binary"))
    )
    hits = found.select(F.col("key").alias(key)).distinct()
    return marked.join(hits, key, "left_anti").select(*[f"`{c}`" for c in docs.columns])


