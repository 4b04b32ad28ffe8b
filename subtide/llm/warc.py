"""WARC archives: written from pages, read back by boundary-chain verification.

Writing. A page becomes a response record, or, if a page with the same payload of at least
`REVISIT_BYTES` and a larger id exists, a revisit that names it. Spark's text writer puts the
records one after another (a record ends with two line ends, its `lineSep`), so any file system that
Spark reaches will do. Rows whose id is the largest of their payload, repeated rows and rows without
an id are responses. Null payloads are empty.

Reading. Archives are split like any text, at the magic `WARC/1.0` instead of line ends: each piece
is a candidate record. From its header a task works out where the record after it must begin. The
magic may stand in a payload, so candidates are verified: a record counts only if the chain of
successors from the file's start reaches it.

* A task knows the offsets within its split only from the first piece on; the bytes of the splits
  before are added up per file (one row per split).
* Within a split a task follows the successors itself, to the first offset beyond the split. Over
  the splits, pointer jumping doubles the step per round: rounds are the logarithm of the number of
  splits of the largest file. Entries of splits lead back to the records within them.
* A verified record whose payload has the magic lies in several pieces; these are fetched by their
  offsets and joined.

An empty table gives no records. Columns other than page_id, url and html take no part, whatever their names.

A record whose header can't be parsed, or that ends beyond its file, breaks the chain there. Every byte of a file
belongs to a verified record unless its chain breaks, so files whose records add up to less are found by adding up
lengths. By default they raise, with their number and some of their names; with `broken="skip"` the records before the
break are returned, and `broken_files` tells where each file breaks. Nothing else is left out: a payload whose pieces
can't be put together raises, and so does one that disagrees with its record's digest, unless told to skip. The whole
payload of a record is one value.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.llm.store import stored
from subtide.sources.scratch import scratch_folder

MAGIC = b"WARC/1.0\r\n"
END = b"\r\n\r\n"
REVISIT_BYTES = 1000
CELL = 1 << 20  # bytes; pieces and the records they may belong to meet by cell

_LINE = "\r\n"
_CANDIDATE = (
    "path string, split long, at long, size long, exit long, type string, record_id string, refers_to string, uri string, "
    "digest string, head long, content long, whole boolean, payload_bytes long, payload_digest string, payload binary"
)


def write_warc(pages: DataFrame, folder: str) -> None:
    """Writes `pages` (page_id, url, html) as WARC files into `folder`."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    payload = F.col("html").cast("binary")
    rows = rows.withColumns({"digest": F.sha1(payload), "bytes": F.length(payload)})
    # Only payloads that come twice; stored, so that the planner knows how many there are.
    again = stored(
        rows.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND largest IS NOT NULL").select("digest", "largest")
    )
    rows = rows.join(again, "digest", "left")
    revisit = F.expr("largest IS NOT NULL AND page_id < largest")
    rows.select(F.when(revisit, _revisit()).otherwise(_response()).alias("value")).write.option("lineSep", END.decode()).text(folder)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _header(kind: str, length: Column, *more: Column) -> Column:
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\x00-\\x20\\x7F]", "_")
    lines = [
        F.lit(MAGIC.decode() + f"WARC-Type: {kind}"),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        *more,
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    return F.concat(F.concat_ws(_LINE, *lines), F.lit(END.decode()))


_HTTP = f"HTTP/1.1 200 OK{_LINE}Content-Type: text/html; charset=utf-8{_LINE}{_LINE}"


def _response() -> Column:
    return F.concat(_header("response", F.col("bytes") + len(_HTTP)), F.lit(_HTTP), F.col("html"))


def _revisit() -> Column:
    profile = F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
    refers = F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("largest")))
    return F.concat(_header("revisit", F.lit(len(_HTTP)), profile, refers), F.lit(_HTTP))


def read_warc(spark: SparkSession, folder: str, payloads: bool = True, broken: str = "raise") -> DataFrame:
    """(path, offset, type, record_id, uri, refers_to, payload_bytes, payload_digest, payload) per record.

    For a revisit, size and digest are those of the payload it refers to; `payload` is null there,
    and everywhere if `payloads` is false. `broken` is "raise" or "skip".
    """
    if broken not in ("raise", "skip"):
        raise ValueError(f"broken is raise or skip, not {broken}")
    candidates = stored(_pieces(spark, folder).mapInArrow(_examined(payloads), _CANDIDATE))
    bases = _bases(candidates)
    records = _reachable(candidates, bases)
    if broken == "raise":
        _refuse(_breaks(records, bases))
    whole = records.where("whole")
    split = records.where("NOT whole")
    columns = ["path", "offset", "type", "record_id", "uri", "refers_to", "payload_bytes", "payload_digest", "payload"]
    found = whole.select(*columns, "digest")
    if not split.isEmpty():
        found = found.unionByName(_joined(spark, folder, bases, split, payloads, broken).select(*columns, "digest"))
    if broken == "raise":
        told = (F.col("type") == "response") & F.col("digest").rlike("^[0-9a-f]{40}$")  # others write it otherwise
        agrees = ~F.coalesce(told, F.lit(False)) | (F.col("digest") == F.col("payload_digest"))
        wrong = F.raise_error(F.concat(F.lit("a payload disagrees with its digest: "), "path", F.lit(" at "), F.col("offset").cast("string")))
        found = found.withColumn("payload_digest", F.when(agrees, F.col("payload_digest")).otherwise(wrong.cast("string")))
    originals = found.where("type = 'response'").groupBy("record_id").agg(F.max("payload_bytes").alias("original_bytes"))
    first = found.where("type = 'revisit'").select("path", "offset", "refers_to").join(originals.withColumnRenamed("record_id", "refers_to"), "refers_to")
    return found.join(first.drop("refers_to"), ["path", "offset"], "left").withColumn(
        "payload_bytes", F.coalesce("original_bytes", "payload_bytes")
    ).select(*columns)


def broken_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, verified, length) of the files whose chain breaks: the bytes before the break, and all."""
    candidates = stored(_pieces(spark, folder).mapInArrow(_examined(False), _CANDIDATE))
    bases = _bases(candidates)
    return _breaks(_reachable(candidates, bases), bases)


def _breaks(records: DataFrame, bases: DataFrame) -> DataFrame:
    """Files that the verified records don't fill."""
    filled = records.groupBy("path").agg(F.sum(F.col("head") + F.col("content") + (len(MAGIC) + len(END))).alias("verified"))
    lengths = bases.groupBy("path").agg(F.sum("bytes").alias("length"))
    return lengths.join(filled, "path", "left").select("path", F.coalesce("verified", F.lit(0)).alias("verified"), "length").where("verified < length")


def _refuse(breaks: DataFrame) -> None:
    told = breaks.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("path", "verified")).alias("first")).first()
    if told["n"]:
        raise ValueError(f"{told['n']} archives break off, the first by name {told['first']['path']} after {told['first']['verified']} bytes")


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", MAGIC.decode()).text(folder).select(
        F.col("value").cast("binary").alias("piece"), meta.file_path.alias("path"), meta.file_block_start.alias("split")
    )


def _parsed(piece: bytes) -> dict | None:
    """The header of a candidate, without the magic."""
    head = piece.find(END)
    if head < 0:
        return None
    fields = {}
    for line in piece[:head].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    length = fields.get(b"content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length) or b"warc-type" not in fields:
        return None
    return {"head": head + len(END), "content": int(length), "fields": fields}


def _payload(block: bytes) -> bytes:
    """What follows the HTTP header."""
    return block.partition(END)[2]


def _examined(payloads: bool):
    """Per piece of a split its offset relative to the split's first piece, and the record it may begin.

    `exit` is where the chain from it leaves the split, relative too; null if it breaks off within.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, key, at = [], None, 0
        schema = pa.schema([
            ("path", pa.string()), ("split", pa.int64()), ("at", pa.int64()), ("size", pa.int64()), ("exit", pa.int64()), ("type", pa.string()),
            ("record_id", pa.string()), ("refers_to", pa.string()), ("uri", pa.string()), ("digest", pa.string()), ("head", pa.int64()), ("content", pa.int64()),
            ("whole", pa.bool_()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
        ])

        def flushed() -> Iterator[pa.RecordBatch]:
            exits: dict[int, int | None] = {}
            for row in reversed(own):  # successors lie behind
                if row["content"] is None:
                    continue
                succ = row["at"] + len(MAGIC) + row["head"] + row["content"] + len(END)
                exits[row["at"]] = row["exit"] = succ if succ >= at else exits.get(succ)
            for i in range(0, len(own), 1000):
                yield pa.RecordBatch.from_pylist(own[i : i + 1000], schema=schema)

        for batch in batches:
            for piece, path, split in zip(batch.column("piece"), batch.column("path"), batch.column("split")):
                here = (path.as_py(), split.as_py())
                if here != key:
                    yield from flushed()
                    own, key, at = [], here, 0
                piece = piece.as_py()
                first = split.as_py() == 0 and at == 0 and not own
                row = dict.fromkeys(schema.names) | {"path": here[0], "split": here[1]}
                if first:  # what stands before the first magic of a file
                    row |= {"at": 0, "size": len(piece)}
                    at += len(piece)
                else:
                    row |= {"at": at, "size": len(MAGIC) + len(piece)}
                    if head := _parsed(piece):
                        row |= _record(piece, head, payloads)
                    at += len(MAGIC) + len(piece)
                own.append(row)
        yield from flushed()

    return run


def _record(piece: bytes, head: dict, payloads: bool) -> dict:
    fields, body = head["fields"], piece[head["head"] :]
    digest = fields.get(b"warc-payload-digest", "").removeprefix("sha1:")
    row = {
        "type": fields[b"warc-type"],
        "record_id": fields.get(b"warc-record-id"),
        "refers_to": fields.get(b"warc-refers-to"),
        "uri": fields.get(b"warc-target-uri"),
        "digest": digest,
        "head": head["head"],
        "content": head["content"],
        "whole": len(body) == head["content"] + len(END) and body.endswith(END),
    }
    return row | (_content(row["type"], digest, body[: head["content"]], payloads) if row["whole"] else {})


def _content(kind: str, digest: str, block: bytes, payloads: bool) -> dict:
    payload = _payload(block)
    if kind == "revisit":
        return {"payload_bytes": len(payload), "payload_digest": digest}
    return {
        "payload_bytes": len(payload),
        "payload_digest": hashlib.sha1(payload).hexdigest(),
        "payload": payload if payloads else None,
    }


def _bases(candidates: DataFrame) -> DataFrame:
    """(path, split, base): where the first piece of each split begins in its file."""
    from pyspark.sql import Window

    sums = candidates.groupBy("path", "split").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    return stored(sums.select("path", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"), "bytes"))


def _reachable(candidates: DataFrame, bases: DataFrame) -> DataFrame:
    """The candidates that the chain from their file's start reaches, with `offset`."""
    placed = candidates.drop("payload").join(bases, ["path", "split"]).withColumn("offset", F.col("base") + F.col("at"))
    jumps = stored(placed.where("exit IS NOT NULL").selectExpr("path", "offset AS here", "base + exit AS there"))
    # The record that a file begins with: the first piece with a magic of its first split.
    starts = placed.where("content IS NOT NULL AND offset = 0").selectExpr("path", "offset AS here")
    entries, reached = stored(starts), starts.count()
    while True:
        onward = entries.join(jumps, ["path", "here"]).selectExpr("path", "there AS here")
        entries = stored(entries.union(onward).distinct())
        if (now := entries.count()) == reached:
            break
        reached = now
        far = jumps.selectExpr("path", "here AS there", "there AS beyond")
        jumps = stored(jumps.join(far, ["path", "there"], "left").selectExpr("path", "here", "coalesce(beyond, there) AS there"))
    links = placed.where("content IS NOT NULL").selectExpr("path", "split", "offset AS here", f"offset + {len(MAGIC) + len(END)} + head + content AS there")
    marked = links.join(entries.withColumn("entry", F.lit(True)), ["path", "here"], "left")
    chained = marked.groupBy("path", "split").applyInArrow(_followed, "path string, split long, offset long")
    offsets = stored(chained).withColumnRenamed("offset", "reached")
    ends = bases.groupBy("path").agg(F.sum("bytes").alias("length"))
    inside = F.expr(f"offset + {len(MAGIC) + len(END)} + head + content <= length")
    whole = candidates.join(bases, ["path", "split"]).withColumn("offset", F.col("base") + F.col("at"))
    return whole.join(offsets, (whole["path"] == offsets["path"]) & (whole["split"] == offsets["split"]) & (F.col("offset") == F.col("reached")), "left_semi").join(
        ends, "path"
    ).where(inside & F.col("content").isNotNull())


def _followed(links: pa.Table) -> pa.Table:
    """Of the candidates of a split, those on the chains from its entries."""
    there = dict(zip(links.column("here").to_pylist(), links.column("there").to_pylist()))
    found = []
    for here, entry in zip(links.column("here").to_pylist(), links.column("entry").to_pylist()):
        while entry and here in there:
            found.append(here)
            here = there.pop(here)
    n = len(found)
    path, split = links.column("path")[0].as_py(), links.column("split")[0].as_py()
    return pa.table({"path": pa.array([path] * n, pa.string()), "split": pa.array([split] * n, pa.int64()), "offset": pa.array(found, pa.int64())})


def _joined(spark: SparkSession, folder: str, bases: DataFrame, records: DataFrame, payloads: bool, broken: str) -> DataFrame:
    """Records that lie in several pieces, with their payload.

    A split's first piece begins at the first magic in it, whatever other splits there are, so the first scan's offsets
    hold for the second. If executors came or went between the scans and splits begin elsewhere, this raises.
    """
    end = F.expr(f"offset + {len(MAGIC) + len(END)} + head + content")
    wanted = records.select("path", "offset", "head", "content", "type", "record_id", "uri", "refers_to", "digest", end.alias("end"))
    cells = wanted.select("*", F.explode(F.expr(f"sequence(offset div {CELL}, (end - 1) div {CELL})")).alias("cell"))
    raws = _pieces(spark, folder).mapInArrow(_raw, "path string, split long, at long, raw binary")
    moved = F.raise_error(F.lit("an archive was split otherwise by the second scan, read it again")).cast("long")
    pieces = raws.join(bases.drop("bytes"), ["path", "split"], "left").withColumn("base", F.coalesce("base", moved))
    pieces = pieces.select("path", (F.col("base") + F.col("at")).alias("begin"), "raw").withColumn("cell", F.expr(f"begin div {CELL}"))
    keys = [c for c in wanted.columns]
    met = cells.join(pieces, ["path", "cell"], "left").where("raw IS NULL OR begin >= offset AND begin < end")
    joined = met.groupBy(*keys).agg(
        F.expr("transform(array_sort(collect_list(IF(raw IS NULL, NULL, struct(begin, raw)))), x -> x.raw)").alias("raws")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                body = b"".join(row.pop("raws"))[len(MAGIC) + row["head"] :]
                block = body[: row["content"]]
                if len(block) < row["content"]:
                    raise ValueError(f"pieces of a record are missing: {row['path']} at {row['offset']}")
                if body[row["content"] :].startswith(END):
                    rows.append({"payload": None} | row | _content(row["type"], row["digest"], block, payloads))
                elif broken == "raise":
                    raise ValueError(f"a record does not end where it says: {row['path']} at {row['offset']}")
            names = ["path", "offset", "type", "record_id", "uri", "refers_to", "payload_bytes", "payload_digest", "payload", "digest"]
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in names} for r in rows], schema=pa.schema(list(zip(names, types))))

    out = "path string, offset long, type string, record_id string, uri string, refers_to string, payload_bytes long, payload_digest string, payload binary, digest string"
    return joined.mapInArrow(run, out)


def _raw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their magic and their offset relative to the split's first piece."""
    key, at, count = None, 0, 0
    for batch in batches:
        rows = []
        for piece, path, split in zip(batch.column("piece"), batch.column("path"), batch.column("split")):
            here = (path.as_py(), split.as_py())
            if here != key:
                key, at, count = here, 0, 0
            raw = piece.as_py() if here[1] == 0 and count == 0 else MAGIC + piece.as_py()
            rows.append({"path": here[0], "split": here[1], "at": at, "raw": raw})
            at, count = at + len(raw), count + 1
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("split", pa.int64()), ("at", pa.int64()), ("raw", pa.binary())]))


def archived_pages(pages: DataFrame) -> DataFrame:
    """Writes `pages` as WARC files into the shared folder and returns what reading them back finds, per page."""
    folder = scratch_folder(pages.sparkSession)
    write_warc(pages, folder)
    records = read_warc(pages.sparkSession, folder, payloads=False)
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    as_id = lambda c: F.when(page(c) != "", page(c)).cast("long")
    return records.select(
        as_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), as_id("refers_to").alias("refers_to")
    )
