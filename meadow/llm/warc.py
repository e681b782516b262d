"""WARC archives: written record by record, read back by byte ranges with boundary-chain verification.

Reading splits files at the record magic, wherever it stands. Each piece is a candidate record; its header tells where its
successor would begin. Within a range tasks follow these offsets at once, between ranges the chain is followed by
pointer jumping from the start of the file. Only candidates that the chain reaches are records; the magic inside a
payload is never reached, and its piece is given back to the record that it is part of.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from meadow.llm.common import settle
from meadow.sources.tables import work_folder

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
_LENGTH = re.compile(rb"(?i)(?:^|\r\n)content-length:[ \t]*([0-9]+)[ \t]*(?=\r\n|$)")


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@F.pandas_udf(T.StringType())
def _digest(payloads: pd.Series) -> pd.Series:
    return payloads.map(lambda p: payload_digest(p.encode("utf-8", "replace")))


def plan(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that revisit another: of equal payloads of at least `min_bytes` bytes the
    smallest page_id is the response. Equal means equal digest and length; pages with a null id are never referred to
    and never revisit."""
    html = F.coalesce("html", F.lit(""))
    at = settle(pages.select("page_id", _digest(html).alias("digest"), F.octet_length(html).cast("long").alias("bytes")), "digests")
    at = at.filter((F.col("bytes") >= min_bytes) & F.col("page_id").isNotNull())
    many = at.groupBy("digest", "bytes").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return at.join(many.drop("n"), ["digest", "bytes"]).filter("page_id <> refers_to").select("page_id", "refers_to").distinct()


def _header(page: Column, url: Column, digest: Column, size: Column, refers: Column) -> Column:
    """Header lines of one record, up to the empty line. Line breaks in a URL become spaces."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda i: F.concat(F.lit("<urn:page:"), i.cast("string"), F.lit(">"))
    revisit = refers.isNotNull()
    return F.concat(
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.when(page.isNotNull(), line("WARC-Record-ID", urn(page))).otherwise(""),
        F.when(url.isNotNull(), line("WARC-Target-URI", F.regexp_replace(url, "[\\r\\n]", " "))).otherwise(""),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)), line("X-Payload-Length", size.cast("string")),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(refers)), line("WARC-Profile", F.lit(
            "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")))).otherwise(""),
        line("Content-Type", F.lit("text/html")), line("Content-Length", F.when(revisit, F.lit(0)).otherwise(size).cast("string")), F.lit("\r\n"))


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """One record per page row, payload the html in UTF-8 (null: empty). Spark's text writer puts the bytes of a record and
    its closing lines to files, so commits and retries are Spark's. The revisit list is written first, so that the
    planner knows its size when it joins it with the pages."""
    revisits = settle(plan(pages, min_bytes), "revisits")
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).join(revisits, "page_id", "left")
    head = _header(F.col("page_id"), F.col("url"), _digest("html"), F.octet_length("html"), F.col("refers_to"))
    body = F.when(F.col("refers_to").isNull(), F.col("html")).otherwise("")
    rows.select(F.concat(F.lit(MAGIC), head, body).alias("value")).write.option("lineSep", END).text(folder)


def _place(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Rows (file, block, nth, at, piece) in the order of the range; `at` counts bytes from the range's first piece."""
    key, nth, at = None, 0, 0
    for pdf in batches:
        for piece, file, block in zip(pdf["piece"], pdf["file"], pdf["block"], strict=True):
            if (file, block) != key:
                key, nth, at = (file, block), 0, 0
            yield file, block, nth, at, piece
            nth, at = nth + 1, at + len(piece) + len(MAGIC)


def _size(piece: bytes) -> int | None:
    """Bytes of the record that this piece begins, magic and closing lines with it; None without a header."""
    head = piece.find(END.encode())
    found = _LENGTH.search(piece, 0, head) if head >= 0 else None
    return len(MAGIC) + head + int(found[1]) + 2 * len(END) if found else None


def _emit_candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per piece its candidate record and, following successors inside the range, where its chain leaves the range."""
    def flush(key: tuple, rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["nth", "at", "bytes", "size"])
        exits: dict[int, int | None] = {}
        for _, at, _, size in reversed(rows):
            to = None if size is None else at + size
            exits[at] = exits.get(to) if to is not None and to <= rows[-1][1] else to
        out["exit"] = pd.array([exits[at] for at in out["at"]], "Int64")
        out["size"] = out["size"].astype("Int64")
        return out.assign(file=key[0], block=key[1])[["file", "block", "nth", "at", "bytes", "size", "exit"]]

    key, rows = None, []
    for file, block, nth, at, piece in _place(batches):
        if (file, block) != key:
            if rows:
                yield flush(key, rows)
            key, rows = (file, block), []
        rows.append((nth, at, len(piece) + len(MAGIC), None if block == nth == 0 else _size(piece)))
    if rows:
        yield flush(key, rows)


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    """One range: from the chain's entry from record to record. Pieces that are not whole records, with their owner; and
    with nth -1 the last record reached."""
    pdf = pdf.sort_values("start")
    due = pdf["entry"].iloc[0]
    out, owner = [], None
    if pd.isna(due):
        due = None
    for nth, start, size, whole in zip(pdf["nth"], pdf["start"], pdf["size"], pdf["whole"], strict=True):
        if due is not None and start == due and not pd.isna(size):
            owner, due = start, start + size
            if whole:
                continue
        out.append((nth, start, owner, due))
    out.append((-1, -1, owner, due))
    res = pd.DataFrame(out, columns=["nth", "start", "owner", "until"]).astype({"owner": "Int64", "until": "Int64"})
    return res.assign(file=pdf["file"].iloc[0], block=pdf["block"].iloc[0])[["file", "block", "nth", "start", "owner", "until"]]


def _reached(cand: DataFrame) -> DataFrame:
    """(file, start) at which the chain from the file's start enters a range, by pointer jumping over ranges."""
    zero = cand.groupBy("file").agg(F.lit(0).cast("long").alias("start"))
    exits = cand.select("file", F.col("exit").alias("start")).filter("start is not null").unionByName(zero).distinct()
    jump = settle(cand.join(exits, ["file", "start"]).filter("exit is not null").select("file", "start", "exit"), "jumps")
    seen, n = settle(zero, "seen"), -1
    while (now := seen.count()) != n:
        n = now
        more = seen.join(jump, ["file", "start"]).select("file", F.col("exit").alias("start"))
        seen = settle(seen.unionByName(more).distinct(), "seen")
        on = jump.select("file", F.col("start").alias("exit"), F.col("exit").alias("to"))
        jump = settle(jump.join(on, ["file", "exit"], "left").select("file", "start", F.coalesce("to", "exit").alias("exit")), "jumps")
    return seen


_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for record in pdf["record"]:
            head, _, rest = record.partition(END.encode())
            field = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n") if ": " in x)
            number = lambda k: int(field[k][len("<urn:page:"):-1]) if k in field else None
            payload = rest[:int(field["Content-Length"])]
            revisit = field["WARC-Type"] == "revisit"
            digest = field["WARC-Payload-Digest"][len("sha1:"):] if revisit else payload_digest(payload)
            rows.append((number("WARC-Record-ID"), int(field["X-Payload-Length"]) if revisit else len(payload), digest, field["WARC-Type"],
                         number("WARC-Refers-To"), field.get("WARC-Target-URI"), None if revisit else payload))
        out = pd.DataFrame(rows, columns=[x.split()[0] for x in _RECORD.split(", ")])
        yield out.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all archives of a folder: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload.

    Size and digest of a response are those of the bytes read, of a revisit those its header states. Bytes that no chain
    reaches (before a file's first record, or after a broken one) give no record. An empty folder gives no rows.
    """
    raw = spark.read.option("lineSep", MAGIC).text(folder)
    raw = raw.select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"))
    cand = settle(raw.mapInPandas(_emit_candidates, "file string, block long, nth long, at long, bytes long, size long, exit long"), "candidates")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    spans = cand.groupBy("file", "block").agg(F.max(F.col("at") + F.col("bytes")).alias("span"))
    base = settle(spans.select("file", "block", (F.coalesce(F.sum("span").over(earlier), F.lit(0)) - len(MAGIC)).alias("base")), "ranges")
    cand = settle(cand.join(base, ["file", "block"]).select(
        "file", "block", "nth", (F.col("base") + F.col("at")).alias("start"), "size", (F.col("base") + F.col("exit")).alias("exit"),
        (F.col("size") == F.col("bytes")).alias("whole")), "candidates")
    entries = cand.join(_reached(cand), ["file", "start"]).groupBy("file", "block").agg(F.min("start").alias("entry"))
    walked = cand.join(entries, ["file", "block"], "left").select("file", "block", "nth", "start", "size", "whole", "entry")
    walked = settle(walked.groupBy("file", "block").applyInPandas(
        _walk, "file string, block long, nth long, start long, owner long, until long"), "walked")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = walked.filter("nth = -1").select("file", "block", F.last("owner", True).over(before).alias("_owner"),
                                            F.last("until", True).over(before).alias("_until"))
    odd = walked.filter("nth >= 0").join(last, ["file", "block"]).select(
        "file", "block", "nth", "start", F.coalesce("owner", "_owner").alias("owner"),
        F.when(F.col("owner").isNull(), F.col("_until")).otherwise(F.col("until")).alias("until"))
    odd = settle(odd, "odd")

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, nth = None, 0
        for pdf in batches:
            places = []
            for at in zip(pdf["file"], pdf["block"], strict=True):
                key, nth = at, nth + 1 if at == key else 0
                places.append(nth)
            yield pdf.assign(nth=places)[["file", "block", "nth", "piece"]]

    pieces = raw.mapInPandas(numbered, "file string, block long, nth long, piece binary").join(odd, ["file", "block", "nth"], "left")
    whole = pieces.filter("start is null").select(F.col("piece").alias("record"))
    parts = pieces.filter("start is not null and owner is not null and start < until").groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("p"))
    magic = F.lit(MAGIC).cast("binary")
    glued = parts.select(F.substring(F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, magic, x["piece"])),
                                     F.lit(len(MAGIC) + 1), F.lit(2**31 - 1)).alias("record"))
    return whole.unionByName(glued).mapInPandas(_parse, _RECORD)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back, without the payloads."""
    spark = pages.sparkSession
    folder = work_folder(spark, "warc")
    write(pages, folder, min_bytes)
    return read(spark, folder).drop("payload")
