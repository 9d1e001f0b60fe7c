"""WARC archives written and read back by Spark.

Writing: one record per page. Of pages with equal payloads of at least `MIN_REVISIT` bytes the
smallest id is the response, the others are revisits that refer to it. A record is its header
and payload as text; Spark's text writer ends it with the two empty lines of the format.

Reading: Spark's text reader splits the files at the record magic, wherever it stands, and
blocks of one file are read by different tasks. Each task sums the bytes of its pieces, and
running sums over the blocks give the byte offset of every piece. A piece with a readable header
is a candidate record; its header gives the offset of its successor. Magic inside a payload
gives false candidates, so the chain of boundaries is verified: inside a block the successors
are followed to the first offset beyond it (the exit); exits lead from block to block, and
pointer jumping from the start of the file finds the entry of each block; the records on the
chain from the entry are kept. Payloads that hold magic are joined again from their pieces.

The reader takes archives of others, too: versions 1.0 and 1.1, header names in any case, any record
ids (that of a page is its number, others stay whole), compressed files of one member per record
(which Spark reads by one task a file). A record's payload is its block.

Defined results: a null html is an empty payload; a null id is written as `-` and read back as
null; repeated ids are records of their own (a revisit refers to the smallest id); an empty
table gives no rows; columns other than id, url and html are not read; a very long payload is one
value in its task. An archive that is damaged is read up to the damage.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkseries.llm.shared import shared_dir, written

# The format's record magic (written, and the part that all versions share), line end,
# record end, and the profile of a revisit whose payload is that of another record
MAGIC = "WARC/1.0\r\n"
SPLIT = "WARC/1."
VERSIONS = (b"0\r\n", b"1\r\n")
IDENTICAL = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
CRLF = "\r\n"
RECORD_END = "\r\n\r\n"
MIN_REVISIT = 100


def records(pages: DataFrame, id_: str = "page_id", url: str = "url", html: str = "html", date: Column | None = None) -> DataFrame:
    """(value): each page's record without its end. `date` is a timestamp in UTC, now if not given."""
    date = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()) if date is None else date
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(id_).alias("id"), F.col(url).alias("url"), payload.alias("payload"), F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2(F.col("payload").cast("binary"), 256)})
    firsts = rows.where((F.col("size") >= MIN_REVISIT) & F.col("id").isNotNull()).groupBy("digest", "size").agg(
        F.min("id").alias("low"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    # Written, so that Spark knows its size and need not move the payloads while it is small.
    firsts = written(firsts, "firsts")
    rows = rows.join(firsts, ["digest", "size"], "left")
    revisit = F.coalesce(F.col("low") != F.col("id"), F.lit(False))
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    header = F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(CRLF),
        F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("-")), F.lit(">" + CRLF),
        F.lit("WARC-Date: "), F.coalesce("date", F.lit("1970-01-01T00:00:00Z")), F.lit(CRLF),
        F.lit("WARC-Target-URI: "), clean, F.lit(CRLF),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("low").cast("string"), F.lit(f">{CRLF}WARC-Profile: {IDENTICAL}{CRLF}")))
        .otherwise(F.lit("Content-Type: text/html; charset=utf-8" + CRLF)),
        F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit(CRLF),
        F.lit("WARC-Payload-Length: "), F.col("size").cast("string"), F.lit(CRLF),
        F.lit("Content-Length: "), F.when(revisit, "0").otherwise(F.col("size").cast("string")), F.lit(CRLF + CRLF))
    return rows.select(F.concat(header, F.when(revisit, "").otherwise(F.col("payload"))).alias("value"))


def write_archives(pages: DataFrame, path: str, **names) -> None:
    """Write the records as WARC files into a folder."""
    records(pages, **names).write.option("lineSep", RECORD_END).text(path)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): what stands between record magics, in file order within a block."""
    return spark.read.option("lineSep", SPLIT).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


HEAD = ("type", "id", "refers", "digest", "length")


def header_of(value: bytes) -> tuple[int, int, tuple] | None:
    """(header bytes, content bytes, fields of HEAD) of a piece, None if it has no readable header."""
    end = value.find(b"\r\n\r\n")
    if end < 0 or not value.startswith(VERSIONS):
        return None
    lines = (line.split(b":", 1) for line in value[3:end].split(b"\r\n") if b":" in line)
    fields = {name.strip().lower(): rest.strip() for name, rest in lines}
    content = fields.get(b"content-length", b"")
    if not content.isdigit() or len(content) > 18:
        return None
    text = lambda name: fields[name].decode("utf-8", "replace") if name in fields else None
    names = (b"warc-type", b"warc-record-id", b"warc-refers-to", b"warc-payload-digest", b"warc-payload-length")
    return end + 4, int(content), tuple(text(name) for name in names)


def candidates(found: DataFrame) -> DataFrame:
    """One row per piece, with offsets within its block: nth, at, bytes of the piece, and for
    candidates the successor's offset, header fields, payload size and the SHA-256 of what the
    piece holds of the payload. `nth` -1 is the block's own row: its bytes in all."""


    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nth, at = None, 0, 0
        width = 10 + len(HEAD)

        def rows_of(rows):
            columns = list(zip(*rows)) if rows else [()] * width
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            rows = []
            files, blocks, values = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for i in range(batch.num_rows):
                if (files[i], blocks[i]) != now:
                    if now:
                        rows.append((*now, -1, 0, at, None, None, None, None, None, *[None] * len(HEAD)))
                    now, nth, at = (files[i], blocks[i]), 0, 0
                value = values[i].as_py()
                # A piece stands behind its magic, except a file's first piece.
                head = header_of(value) if (blocks[i] or nth) else None
                begin = at - len(SPLIT)
                if head:
                    skip, size, fields = head
                    payload = value[skip : skip + size]
                    rows.append((*now, nth, begin, len(value), begin + len(SPLIT) + skip + size + len(RECORD_END), skip, size,
                                 hashlib.sha256(payload).hexdigest(), len(payload) == size, *fields))
                else:
                    rows.append((*now, nth, begin, len(value), None, None, None, None, None, *[None] * len(HEAD)))
                at += len(value) + len(SPLIT)
                nth += 1
            yield rows_of(rows)
        if now:
            yield rows_of([(*now, -1, 0, at, None, None, None, None, None, *[None] * len(HEAD))])

    names = ["file", "block", "nth", "at", "bytes", "next", "skip", "size", "sha", "whole", *HEAD]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), *[pa.string()] * len(HEAD)]
    types = "file string, block long, nth long, at long, bytes long, next long, skip long, size long, sha string, whole boolean"
    return found.mapInArrow(run, types + "".join(f", {h} string" for h in HEAD))


def with_offsets(rows: DataFrame) -> DataFrame:
    """Candidates and pieces with offsets in their file."""
    sums = rows.where("nth = -1").groupBy("file", "block").agg(F.sum("bytes").alias("total"))
    # Few rows: one per block of a file.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0))).select("file", "block", "base", "total")
    out = rows.where("nth >= 0").join(bases, ["file", "block"])
    return out.withColumns({"at": F.col("at") + F.col("base"), "next": F.col("next") + F.col("base"), "until": F.col("base") + F.col("total") - len(SPLIT)})


def exits(rows: DataFrame) -> DataFrame:
    """(file, block, at, exit): for each candidate the first offset of its chain at or beyond
    the block's end (null if the chain breaks inside the block)."""

    def run(pdf):
        pdf = pdf.sort_values("at")
        at, nxt, until = pdf["at"].to_numpy(), pdf["next"].to_numpy(), int(pdf["until"].iloc[0])
        where = {int(a): i for i, a in enumerate(at)}
        out = np.full(len(at), -1, np.int64)
        for i in range(len(at) - 1, -1, -1):
            if nxt[i] >= until:
                out[i] = nxt[i]
            elif int(nxt[i]) in where:
                out[i] = out[where[int(nxt[i])]]
        pdf["exit"] = out
        return pdf[["file", "block", "at", "exit"]]

    return rows.select("file", "block", "at", "next", "until").groupBy("file", "block").applyInPandas(
        run, "file string, block long, at long, exit long")


def entries(out: DataFrame) -> DataFrame:
    """(file, at): the chain's first candidate in each block, by pointer jumping over exits from
    the start of the file."""
    targets = out.select("file", F.col("exit").alias("at")).where("at >= 0").unionByName(
        out.select("file").distinct().withColumn("at", F.lit(0).cast("long"))).distinct()
    hops = written(out.join(targets, ["file", "at"]).select("file", "at", F.when(F.col("exit") >= 0, F.col("exit")).alias("to")).where("to is not null"), "hops")
    reached = written(out.where("at = 0").select("file", "at").distinct(), "reached")
    while not hops.isEmpty():
        # The reached set doubles: where its members lead, then every hop becomes two hops.
        new = reached.join(hops, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = written(reached.unionByName(new).distinct(), "reached")
        beyond = hops.select("file", F.col("at").alias("to"), F.col("to").alias("then"))
        hops = written(hops.join(beyond, ["file", "to"]).select("file", "at", F.col("then").alias("to")), "hops")
    return reached


def verified(rows: DataFrame) -> DataFrame:
    """The candidates that are reachable from the start of their file."""
    chained = rows.where(F.col("next").isNotNull())
    heads = entries(written(exits(chained), "exits")).withColumnRenamed("at", "entry")
    slim = chained.select("file", "block", "at", "next", "until")
    first = slim.join(heads, (slim["file"] == heads["file"]) & (slim["at"] == heads["entry"])).select(slim["file"], "block", "entry").groupBy("file", "block").agg(F.min("entry").alias("entry"))

    def follow(pdf):
        where = dict(zip(pdf["at"].tolist(), pdf["next"].tolist()))
        kept, at = [], int(pdf["entry"].iloc[0])
        while at in where:
            kept.append(at)
            at = int(where[at])
        return pdf[pdf["at"].isin(kept)][["file", "block", "at"]]

    on_chain = slim.join(first, ["file", "block"]).groupBy("file", "block").applyInPandas(follow, "file string, block long, at long")
    return chained.join(on_chain, ["file", "block", "at"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: record_type, record_id, refers_to, and of the full payload
    payload_bytes and payload_digest (a revisit's from its header)."""
    found = pieces(spark, path)
    rows = written(with_offsets(candidates(found)), "pieces")
    good = written(verified(rows), "records")
    split = good.where(~F.col("whole"))
    whole = good.where("whole").select(*HEAD, F.col("size").alias("got"), "sha")
    if not split.isEmpty():
        whole = whole.unionByName(joined_pieces(found, rows, split))
    name = lambda c: F.regexp_replace(F.regexp_replace(c, r"^<(.*)>$", "$1"), "^urn:page:", "")
    known = lambda c: F.when(~name(c).isin("", "-"), name(c))
    revisit = F.col("type") == "revisit"
    return whole.select(
        F.col("type").alias("record_type"), known(F.col("id")).alias("record_id"), known(F.col("refers")).alias("refers_to"),
        F.when(revisit, F.col("length").cast("long")).otherwise(F.col("got")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("digest", "^sha256:", "")).otherwise(F.col("sha")).alias("payload_digest"))


def joined_pieces(found: DataFrame, rows: DataFrame, split: DataFrame) -> DataFrame:
    """Size and digest of payloads that hold the magic: their pieces, found by offset, in order.

    A piece belongs to the one record whose range it starts in; ranges are matched by buckets of
    offsets, so no record is compared with all pieces.
    """
    step = 1 << 20
    spans = split.select("file", *HEAD, F.col("at").alias("start"), F.col("next").alias("stop"), "skip", "size",
                         F.explode(F.sequence(F.floor(F.col("at") / step), F.floor((F.col("next") - 1) / step))).alias("bucket"))
    places = rows.select("file", "block", "nth", "at", F.floor(F.col("at") / step).alias("bucket"))
    inside = places.join(spans, ["file", "bucket"]).where((F.col("at") >= F.col("start")) & (F.col("at") < F.col("stop"))).drop("bucket")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nth = None, 0
        for batch in batches:
            ranks = []
            for here in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                now, nth = (here, 0) if here != now else (now, nth + 1)
                ranks.append(nth)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ranks, pa.int64())], ["file", "block", "value", "nth"])

    texts = found.mapInArrow(numbered, "file string, block long, value binary, nth long")
    parts = texts.join(inside, ["file", "block", "nth"])
    # One record's pieces meet in one task, as its payload must to be hashed.
    ordered = F.array_sort(F.collect_list(F.struct("at", "value")))
    magic = SPLIT.encode().hex().upper()
    body = F.unhex(F.concat(F.lit(magic), F.array_join(F.transform(ordered, lambda x: F.hex(x["value"])), magic)))
    whole = parts.groupBy("file", "start", "skip", "size", *HEAD).agg(body.alias("body"))
    payload = F.substring(F.col("body"), F.col("skip").cast("int") + len(SPLIT) + 1, F.col("size").cast("int"))
    return whole.withColumn("payload", payload).select(*HEAD, F.octet_length("payload").cast("long").alias("got"), F.sha2("payload", 256).alias("sha"))


def round_trip(pages: DataFrame, **names) -> DataFrame:
    """Write the pages into a new folder of the shared directory and read the archives back."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, **names)
    return read_archives(spark, path)
