"""Web archives: records written as WARC files and read back in parallel from any place in a file.

A file is split into blocks like any other text. A task cannot know which lines of its block start a record, as
a payload may hold the same magic line. So it offers every such line as a candidate with the offset at which
its record would end, and follows these pointers as long as they stay in the block. Between blocks, pointer
jumping from the start of the file finds the one candidate of each block that the chain of records reaches;
all other candidates are payload. Then every block is cut into records from its own entry on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from replyscope.llm.rows import forget, stored
from replyscope.operators.skew import lookup_join
from replyscope.session import scratch_path

MAGIC = b"WARC/1.1\r"
BREAK = "\r\n"
# Behind every record stand two line breaks
RECORD_END = BREAK * 2
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Smaller payloads are always written in full
REVISIT_BYTES = 1000
# A table of at most so many rows of two short columns goes to all tasks
BROADCAST_ROWS = 500_000
HOT_ROWS = 10_000
# Blocks whose entries go to all tasks together; larger sets of archives are read in turns
MOST_BLOCKS = 200_000
# Short enough for its line to be told from its first bytes
LENGTH_RE = re.compile(rb"content-length:[ \t]{0,8}([0-9]{1,18})[ \t]{0,8}\r?\Z", re.IGNORECASE)


def record_name(page_id: Column, fingerprint: Column) -> Column:
    """A URN for a page with a payload; equal rows have the same."""
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(":"), F.substring(fingerprint, 1, 32))


def with_originals(pages: DataFrame, page_id: str, least: int) -> DataFrame:
    """Add ``_original``, the largest page id with the same payload, where a row with that payload revisits it.

    Equal payloads are told by SHA-256. Only digests are grouped, with maxima made in the tasks, and only those of
    repeated payloads are joined to the pages: as a broadcast if they are few, else with the rows of
    frequent payloads kept in place.
    """
    large = pages.where(F.octet_length("_payload") >= least).select("_fingerprint", page_id)
    groups = large.groupBy("_fingerprint").agg(F.max(page_id).alias("_original"), F.count("*").alias("_n"))
    repeated = stored(groups.where((F.col("_n") > 1) & F.col("_original").isNotNull()).drop("_n"), "repeated-payloads")
    if repeated.count() <= BROADCAST_ROWS:
        joined = pages.join(F.broadcast(repeated), "_fingerprint", "left")
    else:
        joined = lookup_join(pages, repeated, "_fingerprint", "left", hot_rows=HOT_ROWS)
    again = F.col(page_id).isNull() | (F.col(page_id) != F.col("_original"))
    return joined.withColumn("_original", F.when(again, F.col("_original")))


def as_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """(record): one WARC record per page as text, without the line breaks behind it.

    A null payload is empty. Of equal payloads of ``least`` bytes or more, rows with the largest page id are
    responses and the others revisit records without a payload; a null id is never the largest, and if all are null,
    all are responses. Rows that repeat id and payload are alike. Control characters of a URL are written as
    percent escapes; without a URL its header is left out. Only the three columns are looked at.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("_payload"))
    rows = rows.withColumn("_fingerprint", F.sha2(F.col("_payload").cast("binary"), 256))
    decided = with_originals(rows, "page_id", least)
    revisit = F.col("_original").isNotNull()
    escaped = F.col("url")
    for code in range(32):
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    target = F.when(F.col("url").rlike(r"[\x00-\x1F]"), escaped).otherwise(F.col("url"))

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))

    def name_of(page: Column) -> Column:
        return F.concat(F.lit("<"), record_name(page, F.col("_fingerprint")), F.lit(">"))

    lines = [
        F.lit(MAGIC.decode() + "\n"),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", name_of(F.col("page_id"))),
        header("WARC-Date", F.lit(DATE)),
        F.coalesce(header("WARC-Target-URI", target), F.lit("")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("_payload").cast("binary")))),
        F.when(revisit, F.concat(header("WARC-Refers-To", name_of(F.col("_original"))), header("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        header("Content-Type", F.lit("text/html; charset=utf-8")),
        header("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.octet_length("_payload")).cast("string")),
        F.lit(BREAK),
        F.when(revisit, F.lit("")).otherwise(F.col("_payload")),
    ]
    return decided.select(F.concat(*lines).alias("record"))


def write_archives(records: DataFrame, path: str) -> None:
    """One WARC file per partition, written by Spark's own text writer, which ends every record with two line breaks."""
    records.select("record").write.option("lineSep", RECORD_END).text(path)


@contextmanager
def fixed_splits(spark: SparkSession):
    """Within this block files are split alike in every read, also if executors come and go."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)


def lines_of(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """(file, block, size, line): the lines of archives, each in the block in which it starts, in file order within a task."""
    lines = spark.read.option("lineSep", "\n").text(files)
    place = ["_metadata.file_path AS file", "_metadata.file_block_start AS block", "_metadata.file_size AS size"]
    return lines.selectExpr(*place, "cast(value AS binary) AS line")


class BlockScan:
    """Candidates of one block, from its notable lines in order. Offsets count from the first line of the block."""

    def __init__(self):
        self.done: dict[int, int] = {}
        self.open: list[list] = []
        self.head_end = self.head_length = None

    def see(self, start: int, end: int, line: bytes) -> None:
        """A line that is the magic, blank, or gives a length; ``end`` is the offset behind its line feed."""
        if line == MAGIC:
            self.open.append([start, None])
        elif line == b"\r":
            for at, length in self.open:
                if length is not None:
                    self.done[at] = end + length + len(RECORD_END)
            self.open = []
            if self.head_end is None:
                self.head_end = end
        elif found := LENGTH_RE.match(line):
            length = int(found[1])
            for candidate in self.open:
                if candidate[1] is None:
                    candidate[1] = length
            if self.head_end is None and self.head_length is None:
                self.head_length = length

    def rows(self, total: int) -> list[tuple]:
        """(at, next, successor, runs_on, length) per candidate, then the block itself as a row without ``at``.

        ``next`` is where the chain from the candidate leaves the block; if it comes to a header that runs on into the
        next block, ``runs_on`` is set and ``length`` is what that header has said so far.
        """
        # Later candidates first, so that a pointer inside the block leads to one already followed
        end_of = {at: (None, True, length) for at, length in self.open}
        for at in sorted(self.done, reverse=True):
            to = self.done[at]
            end_of[at] = end_of.get(to, (None, False, None)) if to < total else (to, False, None)
        found = [(at, *end_of[at], self.done.get(at)) for at in sorted(end_of)]
        out = [(at, to, successor, runs_on, length) for at, to, runs_on, length, successor in found]
        return [*out, (None, self.head_end, total, False, self.head_length)]


SCAN_DDL = "file string, block bigint, size bigint, at bigint, next bigint, successor bigint, runs_on boolean, length bigint"
SCAN_SCHEMA = pa.schema(
    [("file", pa.string()), *((n, pa.int64()) for n in ("block", "size", "at", "next", "successor")), ("runs_on", pa.bool_()), ("length", pa.int64())]
)


def candidates(lines: DataFrame) -> DataFrame:
    """Candidates and blocks (``SCAN_DDL``), offsets relative to the first line of the block. Only lengths and notable lines reach Python."""
    notable = F.col("line").isin(MAGIC, b"\r") | (F.lower(F.substring("line", 1, 15).cast("string")) == "content-length:")
    facts = lines.select("file", "block", "size", F.octet_length("line").alias("n"), F.when(notable, F.substring("line", 1, 200)).alias("told"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, state, position = None, BlockScan(), 0

        def result() -> pa.RecordBatch:
            rows = [(*block, *row) for row in state.rows(position)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SCAN_SCHEMA, strict=True)], schema=SCAN_SCHEMA)

        for batch in batches:
            for part in same_block(batch):
                key = tuple(part.column(n)[0].as_py() for n in ("file", "block", "size"))
                if key != block:
                    if block is not None:
                        yield result()
                    block, state, position = key, BlockScan(), 0
                ends = pc.cumulative_sum(pc.add(part.column("n").cast(pa.int64()), 1)).to_numpy() + position
                told = part.column("told")
                for at in pc.indices_nonzero(told.is_valid()).to_pylist():
                    start = position if at == 0 else int(ends[at - 1])
                    state.see(start, int(ends[at]), told[at].as_py())
                position = int(ends[-1])
        if block is not None:
            yield result()

    return facts.mapInArrow(scan, SCAN_DDL)


def same_block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of one block of one file."""
    if not batch.num_rows:
        return
    block, file = batch.column("block"), batch.column("file")
    changed = pc.or_(pc.not_equal(block[1:], block[:-1]), pc.not_equal(file[1:], file[:-1]))
    edges = [at + 1 for at in pc.indices_nonzero(changed).to_pylist()]
    for start, end in zip([0, *edges], [*edges, batch.num_rows], strict=True):
        yield batch.slice(start, end - start)


def resolved(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(file, at, next, block) of candidates and (file, block, size, base) of blocks, with offsets in the file.

    The offset of a block's first line is the sum of the lines before it. A header that runs on ends at
    the first blank line of the following blocks. Windows run over the blocks of a file, a row each.
    """
    order = Window.partitionBy("file").orderBy("block")
    behind = order.rowsBetween(1, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    blocks = found.where("at is null").select("file", "block", "size", F.col("next").alias("head_end"), F.col("successor").alias("total"), "length")
    blocks = blocks.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0)))
    ends = F.when(F.col("head_end").isNotNull(), F.struct("block", (F.col("base") + F.col("head_end")).alias("end")))
    lengths = F.when(F.col("length").isNotNull(), F.struct("block", "length"))
    blocks = blocks.withColumns({"ends": F.first(ends, True).over(behind), "lengths": F.first(lengths, True).over(behind)})
    later = F.when(F.col("lengths.block") <= F.col("ends.block"), F.col("lengths.length"))
    blocks = stored(blocks.select("file", "block", "size", "base", F.col("ends.end").alias("blank"), later.alias("later")), "blocks")
    rows = found.where("at is not null").select("file", "block", "at", "next", "runs_on", "length").join(blocks, ["file", "block"])
    run_on = F.col("blank") + F.coalesce("length", "later") + len(RECORD_END)
    to = F.when(F.col("runs_on"), run_on).otherwise(F.col("base") + F.col("next"))
    # A record that would end behind the file is cut short: no chain goes on from it
    to = F.when(to <= F.col("size"), to)
    return rows.select("file", "block", (F.col("base") + F.col("at")).alias("at"), to.alias("next")), blocks.select("file", "block", "size", "base")


def reachable(edges: DataFrame) -> DataFrame:
    """(file, at, next, block): the candidates on the chain from the start of each file, the first of each block it enters.

    Pointer jumping: after round k the first 2^k entries are known and every pointer skips 2^k of them, so
    there are as many rounds as the number of blocks of a file has binary digits. Each round is written.
    """
    known = stored(edges.where("at = 0").select("file", "at"), "reached")
    jumps = stored(edges.where("next is not null").select("file", "at", F.col("next").alias("to")), "jumps")
    count, old = known.count(), []
    while count:
        ahead = known.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        more = stored(known.union(ahead).distinct(), "reached")
        old += [known]
        if (size := more.count()) == count:
            known = more
            break
        onward = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("beyond"))
        further = stored(jumps.join(onward, ["file", "to"]).select("file", "at", F.col("beyond").alias("to")), "jumps")
        old += [jumps]
        known, jumps, count = more, further, size
    out = stored(edges.join(known, ["file", "at"], "left_semi"), "entries")
    for table in [*old, known, jumps]:
        forget(table)
    return out


def entries_of_blocks(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """(file, block, base, entry, leaves, until): offsets of the first line, of the first record that starts in the block,
    of the end of its last record, and of the end of the record that runs into the block."""
    found = stored(candidates(lines_of(spark, files)), "candidates")
    edges, blocks = resolved(found)
    edges = stored(edges, "edges")
    on_chain = reachable(edges).select("file", "block", F.col("at").alias("entry"), F.col("next").alias("leaves"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # The last block with an entry tells where its last record ends; null if the chain broke off there
    last = F.last(F.when(F.col("entry").isNotNull(), F.struct("leaves")), True).over(before)
    both = blocks.join(on_chain, ["file", "block"], "left")
    out = stored(both.select("file", "block", "base", "entry", "leaves", last["leaves"].alias("until")), "block-entries")
    for table in (found, edges):
        forget(table)
    return out


def record_of(raw: bytes) -> tuple[int, dict[str, str]] | None:
    """Length of a header and its fields, if ``raw`` starts with a whole one that gives a length. A field's first value counts."""
    if not raw.startswith(MAGIC + b"\n"):
        return None
    end = raw.find(b"\n\r\n")
    if end < 0:
        return None
    fields: dict[str, str] = {}
    for line in raw[len(MAGIC) + 1 : end + 1].split(b"\n"):
        if found := LENGTH_RE.match(line):
            fields.setdefault("content-length", found[1].decode())
        elif b":" in line:
            name, value = line.split(b":", 1)
            if name.strip().lower() != b"content-length":
                fields.setdefault(name.decode("utf-8", "replace").strip().lower(), value.decode("utf-8", "replace").strip())
    return (end + 3, fields) if "content-length" in fields else None


FIELDS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "url": "warc-target-uri", "digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}
RECORD_DDL = "file string, record_offset bigint, " + ", ".join(f"{name} string" for name in FIELDS) + ", payload binary"
PIECE_DDL = RECORD_DDL + ", ends bigint, piece binary"
PIECE_SCHEMA = pa.schema(
    [("file", pa.string()), ("record_offset", pa.int64()), *((n, pa.string()) for n in FIELDS), ("payload", pa.binary()), ("ends", pa.int64()), ("piece", pa.binary())]
)
# Bytes of records handed on at a time
BATCH_BYTES = 8 << 20


def record_row(file: str, offset: int, header: int, fields: dict[str, str], raw: bytes) -> tuple:
    length = int(fields["content-length"])
    values = [fields.get(name) for name in FIELDS.values()]
    return (file, offset, *values, raw[header : header + length], None, None)


class BlockCut:
    """Cuts the lines of one block into records from its entry on; memory holds one record."""

    def __init__(self, file: str, base: int, entry: int | None, leaves: int | None, until: int | None):
        self.file, self.position, self.entry, self.leaves, self.until = file, base, entry, leaves, until
        self.tail, self.held, self.held_bytes, self.head, self.stopped = [], [], 0, None, entry is None
        self.start, self.tail_start = entry, base

    def line(self, raw: bytes) -> tuple | None:
        """Take the next line, with its line feed; returns the record that it completes."""
        at, self.position = self.position, self.position + len(raw)
        if self.until is not None and at < self.until:
            self.tail.append(raw)
        if self.stopped or at < self.entry:
            return None
        self.held.append(raw)
        self.held_bytes += len(raw)
        if self.head is None:
            if len(self.held) == 1 and raw != MAGIC + b"\n":
                self.stopped, self.held = True, []
                return None
            if raw != b"\r\n":
                return None
            self.head = record_of(b"".join(self.held))
            if self.head is None:
                self.stopped, self.held = True, []
                return None
        header, fields = self.head
        needed = header + int(fields["content-length"]) + len(RECORD_END)
        if self.held_bytes < needed:
            return None
        # No record starts inside a line, so one that ends there is the last of the chain
        self.stopped = self.held_bytes > needed
        row = record_row(self.file, self.start, header, fields, b"".join(self.held))
        self.start, self.held, self.held_bytes, self.head = self.position, [], 0, None
        return row

    def pieces(self) -> list[tuple]:
        """What the block has of records that run over its edges, named by where they end."""
        blank = (None,) * (len(FIELDS) + 1)
        out = []
        if self.tail:
            out.append((self.file, self.tail_start, *blank, self.until, b"".join(self.tail)))
        if self.held and self.leaves is not None:
            out.append((self.file, self.start, *blank, self.leaves, b"".join(self.held)))
        return out


def cut_blocks(lines: DataFrame, entries: DataFrame) -> DataFrame:
    """Whole records, and pieces of those that run over the edge of a block (``PIECE_DDL``).

    ``entries`` has a row per block and goes to all tasks. A block without a row was split in another way than
    before; that is an error.
    """
    known = entries.select("file", "block", F.struct("base", "entry", "leaves", "until").alias("cut"))
    placed = lines.select("file", "block", "line").join(F.broadcast(known), ["file", "block"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, rows, size = None, None, [], 0

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECE_SCHEMA, strict=True)], schema=PIECE_SCHEMA)

        for batch in batches:
            for part in same_block(batch):
                name = part.column("file")[0].as_py(), part.column("block")[0].as_py()
                if name != key:
                    rows += block.pieces() if block else []
                    place = part.column("cut")[0].as_py()
                    if place is None:
                        raise RuntimeError(f"{name[0]} was split in another way than before")
                    key, block = name, BlockCut(name[0], **place)
                for line in part.column("line"):
                    raw = line.as_py() + b"\n"
                    row = block.line(raw)
                    size += len(raw)
                    if row is not None:
                        rows.append(row)
                    if rows and size > BATCH_BYTES:
                        yield handed()
                        rows, size = [], 0
        rows += block.pieces() if block else []
        if rows:
            yield handed()

    return placed.mapInArrow(cut, PIECE_DDL)


def joined_pieces(pieces: DataFrame) -> DataFrame:
    """Records from the pieces that end at the same place of a file: at most two for every block, gathered per record."""
    gathered = pieces.where("ends is not null").groupBy("file", "ends").agg(F.sort_array(F.collect_list(F.struct("record_offset", "piece"))).alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, parts in zip(batch.column("file"), batch.column("parts"), strict=True):
                raw = b"".join(part["piece"].as_py() for part in parts)
                found = record_of(raw)
                if found is None or len(raw) < found[0] + int(found[1]["content-length"]):
                    continue
                row = record_row(file.as_py(), parts[0]["record_offset"].as_py(), *found, raw)[:-2]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, PIECE_SCHEMA, strict=False)], names=PIECE_SCHEMA.names[:-2])

    return gathered.mapInArrow(join, RECORD_DDL)


def read_archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, record_offset, record_type, record_id, url, digest, refers_to and payload of every record of WARC files.

    Records are those on the chain from the start of each file: a magic line inside a payload is never one. What
    follows a damaged header or a record cut short by the end of the file is left out. Fields that a header lacks
    are null; files without a record give no rows. Files must not be compressed as a whole. They are read
    twice and the records written once, so the result no longer depends on how files are split. Memory holds
    one record at a time, besides a row for each of at most ``MOST_BLOCKS`` blocks.
    """
    with fixed_splits(spark):
        entries = entries_of_blocks(spark, path)
        done = None
        for files in turns(entries):
            now = entries if files is None else entries.where(F.col("file").isin(files))
            names = path if files is None else files
            pieces = stored(cut_blocks(lines_of(spark, names), now), "pieces", "zstd")
            whole = pieces.where("ends is null").select(*RECORD_DDL_NAMES)
            records = whole.unionByName(joined_pieces(pieces))
            done = records if done is None else done.unionByName(records)
    return done


RECORD_DDL_NAMES = ["file", "record_offset", *FIELDS, "payload"]


def turns(entries: DataFrame, most: int | None = None) -> list[list[str] | None]:
    """Groups of files of at most ``most`` blocks together (a larger file alone); [None] if all fit into one."""
    most = MOST_BLOCKS if most is None else most
    if entries.count() <= most:
        return [None]
    groups, filled = [[]], 0
    for file, blocks in entries.groupBy("file").agg(F.count("*")).orderBy("file").toLocalIterator():
        if groups[-1] and filled + blocks > most:
            groups.append([])
            filled = 0
        groups[-1].append(file)
        filled += blocks
    return groups


def with_payload_facts(records: DataFrame) -> DataFrame:
    """record_id, record_type, refers_to, payload_bytes and payload_digest; a revisit has those of the response it refers to.

    The response's payload is measured, not believed: a header whose digest differs is an error. Only names, sizes and
    digests are joined, as a broadcast if they are few, else with frequent names kept in place.
    """
    measured = F.sha1("payload")
    true = F.when(F.col("digest") == F.concat(F.lit("sha1:"), measured), measured)
    wrong = F.raise_error(F.lit("a payload differs from its digest")).cast("string")
    rows = records.select(
        "record_id",
        "record_type",
        "refers_to",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.col("record_type") == "response", F.coalesce(true, wrong)).alias("payload_digest"),
    )
    rows = stored(rows, "record-facts")
    revisits, responses = rows.where("record_type = 'revisit'"), rows.where("record_type = 'response'")
    names = revisits.select(F.col("refers_to").alias("record_id")).distinct()
    named = responses.join(names, "record_id", "left_semi").groupBy(F.col("record_id").alias("refers_to"))
    originals = stored(named.agg(F.min("payload_bytes").alias("payload_bytes"), F.min("payload_digest").alias("payload_digest")), "originals")
    slim = revisits.drop("payload_bytes", "payload_digest")
    if originals.count() <= BROADCAST_ROWS:
        seen = slim.join(F.broadcast(originals), "refers_to", "left")
    else:
        seen = lookup_join(slim, originals, "refers_to", "left", hot_rows=HOT_ROWS)
    return responses.unionByName(seen)


def archived_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages as WARC files and give what is read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    ``path`` is a new folder, by default one below the shared checkpoint folder. Nulls, ties and repeats are as ``as_records``
    says; an empty table gives an empty one.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc") if path is None else path
    write_archives(as_records(pages), path)
    facts = with_payload_facts(read_archives(spark, path))
    page = lambda name: F.regexp_extract(name, "^<urn:page:(-?[0-9]+):", 1)
    number = lambda name: F.nullif(page(name), F.lit("")).cast("long")
    return facts.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )
