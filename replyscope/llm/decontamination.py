"""Benchmark passages in documents, by hashed token windows.

The windows of all benchmark items are hashed into a bitmap of bounded size, and so are three words of
each. Every window of a document is looked up there inside its row, by the three words first; the few that meet
set bits are then compared, word by word, with the windows themselves. What a text holds depends on the
text alone, so the result is kept per digest of a text and looked up by each row. All of it is built-in column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope.functions.text import let
from replyscope.llm import fixed_values as fixed
from replyscope.llm.rows import sha256_of, stored

WINDOW = 13
# A bitmap has 2^12 bits at least, and 32 for the two hashes of each window; all together have 2^26 (8 MB) at most. Fuller
# ones only let more windows through to the comparison
LEAST_BITS, MOST_BITS = 1 << 12, 1 << 26
# Windows up to this number are broadcast for the comparison: at most some 100 MB
BROADCAST_WINDOWS = 500_000
# Results of texts with benchmark windows are broadcast up to about this size
BROADCAST_BYTES = 32 << 20
# ASCII that no word has
BETWEEN_WORDS = "".join(chr(code) for code in range(128) if not chr(code).isalnum())
NEW = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hits"]


def words_of(text: Column) -> Column:
    """Words of a whole text, A-Z lower-cased; none for null.

    All of ASCII but digits and letters becomes a space, at which a plain split needs no pattern.
    """
    spaced = F.translate(F.coalesce(text, F.lit("")), fixed.UPPER + BETWEEN_WORDS, fixed.LOWER + " " * len(BETWEEN_WORDS))
    return F.array_remove(F.split(spaced, " "), "")


def count_of_words(text: Column) -> Column:
    """Number of words of a whole text; none for null."""
    return F.size(words_of(text)).cast("long")


def windows_of(words: Column, length: int) -> Column:
    """First places (from 0) of all windows of ``length`` words; empty for shorter texts."""
    last = F.size(words) - length
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def probe_of(words: Column, at: Column, length: Column) -> Column:
    """Hash of the first, middle and last word of a window."""
    middle = (length / 2).cast("int")
    return F.xxhash64(F.get(words, at), F.get(words, at + middle), F.get(words, at + length - 1))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(gram, length, hash, probe, item_ids): the distinct windows of all items, words joined by spaces.

    An item with fewer words than a window is one window; an item without words has none.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("_w"))
    length = F.least(F.size("_w"), F.lit(window))
    starts = F.when(F.size("_w") > 0, F.sequence(F.lit(0), F.size("_w") - length)).otherwise(F.array().cast("array<int>"))
    each = items.select("item_id", "_w", length.alias("length"), F.explode(starts).alias("_at"))
    cut = each.withColumn("_gram", F.slice("_w", F.col("_at") + 1, F.col("length")))
    probe = probe_of(F.col("_gram"), F.lit(0), F.col("length"))
    grams = cut.select(
        "item_id", "length", F.array_join("_gram", " ").alias("gram"), F.xxhash64("_gram").alias("hash"), probe.alias("probe")
    )
    return grams.groupBy("gram", "length", "hash", "probe").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))


def bitmap_of(windows: DataFrame, length: int, bits: int) -> Column:
    """The set of both hashes of the windows of one length, as a constant array of 64-bit words.

    The driver gets the words that are not 0, at most ``bits`` / 64 numbers.
    """
    place = F.pmod(F.col("hash"), F.lit(bits))
    rows = (
        windows.where(F.col("length") == length)
        .select(F.explode(F.array("hash", "probe")).alias("hash"))
        .select(F.shiftright(place, 6).cast("int").alias("word"), (place % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("value"))
        .collect()
    )
    values = ["0"] * (bits // 64)
    for word, value in rows:
        values[word] = str(value)
    # Folded into one constant of the plan
    return F.split(F.lit(",".join(values)), ",").cast("array<bigint>")


def hit_places(words: Column, bitmap: Column, length: int, bits: int) -> Column:
    """(at, length, gram) of the windows of a text whose two hashes both meet a set bit.

    The hash of three words is computed once for each window, that of all words only where the first meets a set bit.
    """

    def is_set(hashed: Column) -> Column:
        place = F.pmod(hashed, F.lit(bits))
        word = F.get(bitmap, F.shiftright(place, 6).cast("int"))
        return F.call_function("getbit", word, (place % 64).cast("int")) == 1

    starts = windows_of(words, length)
    probes = F.transform(starts, lambda at: probe_of(words, at, F.lit(length)))
    probed = let(probes, lambda hashes: F.filter(starts, lambda at: is_set(F.get(hashes, at))))
    found = F.filter(probed, lambda at: is_set(F.xxhash64(F.slice(words, at + 1, length))))
    return F.transform(
        found,
        lambda at: F.struct(
            at.alias("at"), F.lit(length).alias("length"), F.array_join(F.slice(words, at + 1, length), " ").alias("gram")
        ),
    )


def covered_words(hits: Column) -> Column:
    """Number of words inside the union of hits, structs (at, length) sorted by ``at``."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(state: Column, hit: Column) -> Column:
        end = F.greatest(state["end"], hit["at"] + hit["length"])
        return F.struct((state["n"] + end - F.greatest(state["end"], hit["at"])).alias("n"), end.alias("end"))

    return F.aggregate(hits, zero, add, lambda state: state["n"])


def bits_of(counts: dict[int, int]) -> dict[int, int]:
    """Size of the bitmap of each window length, a power of two that grows with its windows; ``MOST_BITS`` together."""
    bits = {length: max(LEAST_BITS, 1 << (32 * n - 1).bit_length()) for length, n in counts.items()}
    while sum(bits.values()) > MOST_BITS:
        bits[max(bits, key=bits.get)] //= 2
    return bits


def text_key(text: Column) -> Column:
    """Digest by which rows find the result of their text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """key, hits, n_hit, n_items and items_sha256 of every different text with an occurrence of a benchmark window.

    Candidate windows of equal texts become one before anything is gathered, so a text that very many rows repeat is
    compared once. No text is shuffled, only digests and candidate windows.
    """
    windows = stored(benchmark_windows(benchmark, window), "windows")
    counts = {row["length"]: row["n"] for row in windows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bits = bits_of(counts)
    words = F.col("_words")
    found = [hit_places(words, bitmap_of(windows, length, bits[length]), length, bits[length]) for length in sorted(counts)]
    candidates = F.concat(*found) if found else F.array().cast("array<struct<at:int,length:int,gram:string>>")
    tokens = docs.select(text_key(F.col("text")).alias("key"), words_of(F.col("text")).alias("_words"))
    scanned = tokens.select("key", candidates.alias("found"))
    # An outer explode, as from an inner one a filter is inferred that computes the candidates a second time
    each = scanned.select("key", F.explode_outer("found").alias("hit")).where(F.col("hit").isNotNull()).distinct()
    known = windows.select("gram", "item_ids")
    known = F.broadcast(known) if sum(counts.values()) <= BROADCAST_WINDOWS else known
    checked = each.select("key", "hit", F.col("hit.gram").alias("gram")).join(known, "gram")
    merged = checked.groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("hit.at", "hit.length"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("_ids"),
    )
    return merged.select(
        "key",
        "hits",
        covered_words(F.col("hits")).cast("long").alias("n_hit"),
        F.size("_ids").cast("long").alias("n_items"),
        sha256_of(F.array_join("_ids", ",")).alias("items_sha256"),
    )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, keep: list[str] | None = None
) -> DataFrame:
    """Words of every document that stand inside an occurrence of a benchmark window.

    Adds ``n_words``, ``n_hit``, ``n_items`` (items with occurring windows), ``items_sha256``,
    ``contaminated`` (hit words are at least 1 / ``share`` of the words) and ``hits`` (at, length) to the
    columns ``keep`` of ``docs``; a column with one of these names, in either case, is replaced. Null and
    empty texts have no words and are clean; repeated rows are judged one by one; an empty benchmark hits
    nothing; items without an id hit words but are not counted; texts are read whole, however long, and an
    empty table stays empty. The documents are read twice, once for the windows and once to attach the
    results. These go to all tasks while they are small, and rows keep their place; beyond
    ``BROADCAST_BYTES`` the rows are joined to them by the digest of their text.
    """
    kept = [name for name in (docs.columns if keep is None else keep) if name.lower() not in NEW]
    inner = [f"_in{number}" for number in range(len(kept))]
    found = stored(contaminated_texts(docs.select("text"), benchmark, window), "contaminated")
    size = found.agg(F.coalesce(F.sum(F.size("hits") * 16 + 300), F.lit(0))).first()[0]
    columns = [F.col(f"`{name.replace('`', '``')}`").alias(alias) for name, alias in zip(kept, inner, strict=True)]
    rows = docs.select(*columns, count_of_words(F.col("text")).alias("n_words"), text_key(F.col("text")).alias("key"))
    merged = rows.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "key", "left")
    n_hit, n_items = (F.coalesce(name, F.lit(0).cast("long")) for name in ("n_hit", "n_items"))
    return merged.select(
        *(F.col(alias).alias(name) for name, alias in zip(kept, inner, strict=True)),
        "n_words",
        n_hit.alias("n_hit"),
        n_items.alias("n_items"),
        F.coalesce("items_sha256", sha256_of(F.lit(""))).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
        F.coalesce("hits", F.array().cast("array<struct<at:int,length:int>>")).alias("hits"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns.

    Null and empty texts stay, repeated rows are judged one by one, and columns named as a result are kept as they
    are. An empty table or benchmark gives back what came; long texts are judged whole.
    """
    names = [f"_in{number}" if name != "text" else name for number, name in enumerate(docs.columns)]
    found = find_contamination(docs.toDF(*names), benchmark, window, share)
    return found.where(~F.col("contaminated")).select(*names).toDF(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs``; hit words and what stands between them are cut out of ``text``.

    A null, empty or clean text stays as it is, one that is all benchmark keeps what stands before its first word;
    repeated rows are cut alike, and other columns are kept whatever their names. An empty table stays empty.
    """
    names = [f"_in{number}" if name != "text" else name for number, name in enumerate(docs.columns)]
    found = find_contamination(docs.toDF(*names), benchmark, window)
    word, other = fixed.WORD_ANY_CASE, fixed.WORD_ANY_CASE.replace("[^", "[", 1).replace("]+", "]*", 1)
    # The text before the first word, then each word with what follows it
    lead = F.regexp_extract("text", f"^({other})", 1)
    pieces = F.regexp_extract_all(F.col("text"), F.lit(f"({word}{other})"), F.lit(1))
    covered = F.flatten(F.transform("hits", lambda h: F.sequence(h["at"], h["at"] + h["length"] - 1)))
    left = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), covered)
    cut = F.concat(lead, F.array_join(F.transform(left, lambda at: F.get(pieces, at)), ""))
    text = F.when(F.size("hits") > 0, cut).otherwise(F.col("text"))
    return found.withColumn("text", text).select(*names).toDF(*docs.columns)
