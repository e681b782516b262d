"""Token ids in a binary format compressed by Re-Pair grammars.

Documents go to shards in ascending order of ids. In a shard, frequent neighbours are replaced by a nonterminal, again and
again; rules, the expansion length of each nonterminal and the remaining symbols are stored, so that any document can be
decoded by itself. Shards are rows of a Parquet table: Spark commits and retries them, and any store it knows can hold them.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tokenizers
from pyspark.sql import DataFrame, Window, functions as F

from meadow.llm.common import settle

SHARD_IDS = 1 << 20  # a shard is closed when it has so many ids
END_ID = 2
HEAD = "<4sIIQIII"  # mark, symbol bytes, documents, ids, rules, symbols, first nonterminal
MARK = b"RPG1"
CACHE = 1_000_000  # words a worker remembers; emptied when full
_SPLIT = "<|endoftext|>"
_ODD = "\x1c\x1d\x1e\x1f"  # white space to Python only
_STOP = re.compile(r"(?<=[a-z])([.,!]+)(?=[ \n]|\Z)")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- Encoding ---

def _words(text: str) -> list[str]:
    """Words of a text, in ASCII texts in lower case and with the stop after a letter or digit as a word of its own."""
    if not text.isascii():
        return text.split()
    c = np.frombuffer(text.encode(), np.uint8)
    stop = _CLASS[c] == 1
    if (stop[1:] & (_CLASS[c[:-1]] < 2)).any():  # a run of signs must stay whole
        return _STOP.sub(r" \1", text.lower()).split()
    return text.lower().replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n").split()


#: 0 signs, 1 stops, 2 letters, digits and white space.
_CLASS = np.array([1 if chr(i) in ".," else 2 * (chr(i).isalnum() or chr(i).isspace()) for i in range(128)], np.uint8)


class Encoder:
    """Ids of texts by the tokenizer, whose pieces never cross white space; so each word is encoded once and remembered.

    In an ASCII text upper case and a stop after a letter do not change the ids of the rest (the tokenizer lowers case and
    starts a new piece there), so words are looked up without them."""

    def __init__(self, spec: str):
        # The worker process keeps the words between tasks; the module is by that name in every worker.
        kept = tokenizers.__dict__.setdefault("_meadow_words", {})
        if kept.get("spec") != spec:
            kept.clear()
            kept.update(spec=spec, words={}, model=tokenizers.Tokenizer.from_str(spec))
        self.words, self.model = kept["words"], kept["model"]
        vocab = self.model.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        special = sorted(self.model.get_added_tokens_decoder().items())
        self.split = next((i for i, t in special if t.content == _SPLIT), None)
        self.special = [t.content for _, t in special]

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text, without the end id."""
        plain, out = [], [None] * len(texts)
        for k, text in enumerate(texts):
            if self.split is None or any(s in text for s in self.special) or any(c in text for c in _ODD):
                out[k] = np.array(self.model.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                plain.append((k, _words(text)))
        words, used = self.words, set()
        if len(words) > CACHE:
            words.clear()
        for _, ws in plain:
            used.update(ws)
        new = used.difference(words)
        lone = [w for w in new if w.isascii() and w.isalpha() and w.islower()]  # one piece each, so its last token ends a word
        self._learn(lone, " ", self.ends)
        self._learn([w for w in new if w not in words], _SPLIT, None)
        for k, ws in plain:
            out[k] = np.frombuffer(b"".join(map(words.__getitem__, ws)), np.uint32)
        return out

    def _learn(self, new: list[str], between: str, ends: np.ndarray | None) -> None:
        """Remember the ids of words encoded as one text; where `ends` is given, ids that end a word part them, else the
        special token between them. Words of a block whose parts are not as many are encoded one by one."""
        for at in range(0, len(new), 20000):
            part = new[at:at + 20000]
            ids = np.array(self.model.encode_batch_fast([between.join(part)], add_special_tokens=False)[0].ids, np.uint32)
            if ends is not None:
                stop = (np.flatnonzero(ends[ids]) + 1).tolist()
                begin = [0, *stop[:-1]]
            else:
                cut = np.flatnonzero(ids == self.split)
                begin, stop = [0, *(cut + 1).tolist()], [*cut.tolist(), len(ids)]
            if len(stop) == len(part):
                raw = ids.tobytes()
                self.words.update((w, raw[4 * a:4 * b]) for w, a, b in zip(part, begin, stop, strict=True))
            else:
                for w in part:
                    self.words[w] = np.array(self.model.encode(w, add_special_tokens=False).ids, np.uint32).tobytes()


# --- Grammar ---

def compress(ids: np.ndarray, first: int, share: float = 1 / 4096, least: int = 8, at_once: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Re-Pair of one shard: rules (n x 2) and the remaining symbols. Nonterminals count from `first`.

    Each round counts neighbours, gives the (up to `at_once`) most frequent pairs a nonterminal each, and replaces their
    occurrences from left to right. It ends when no pair occurs in `share` of the symbols (and `least` times). Pairs never
    begin with END_ID, so no nonterminal goes over the end of a document."""
    s, rules = ids.astype(np.uint32), []
    slots = 1 << 18
    while len(s) > 1:
        floor = max(least, int(len(s) * share))
        slot = (s[:-1] * np.uint32(0x9E3779B1) + s[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(14)
        often = np.bincount(slot, minlength=slots) >= floor
        at = np.flatnonzero(often[slot])
        at = at[s[at] != END_ID]
        pair = s[at].astype(np.uint64) << np.uint64(32) | s[at + 1]
        kinds, count = np.unique(pair, return_counts=True)
        best = np.flatnonzero(count >= floor)
        best = np.sort(best[np.argsort(-count[best], kind="stable")[:at_once]])
        if not len(best):
            break
        chosen = kinds[best]
        k = np.minimum(np.searchsorted(chosen, pair), len(chosen) - 1)
        hit = chosen[k] == pair
        at, k = at[hit], k[hit]
        run = np.flatnonzero(np.diff(at, prepend=-2) != 1)  # overlapping occurrences: every other one, from the left
        even = (np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0
        at, k = at[even], k[even]
        s = s.copy()
        s[at] = first + len(rules) + k
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        s = s[keep]
        rules += [(int(p >> np.uint64(32)), int(p & np.uint64(0xFFFFFFFF))) for p in chosen]
    return np.array(rules, np.uint32).reshape(-1, 2), s


def pack(docs: list[tuple[int | None, np.ndarray]], first: int) -> bytes:
    """One shard: head, documents (id, whether it is null, number of ids), rules, their expansion lengths, symbols."""
    ids = np.concatenate([d for _, d in docs])
    rules, s = compress(ids, first)
    length = np.ones(first + len(rules), np.uint32)
    for i, (a, b) in enumerate(rules):
        length[first + i] = length[a] + length[b]
    width = 2 if first + len(rules) <= 65536 else 4
    return b"".join([
        struct.pack(HEAD, MARK, width, len(docs), len(ids), len(rules), len(s), first), np.array([d or 0 for d, _ in docs], "<i8").tobytes(),
        np.array([d is None for d, _ in docs], np.uint8).tobytes(), np.array([len(x) for _, x in docs], "<u4").tobytes(),
        rules.astype("<u4").tobytes(), length[first:].astype("<u4").tobytes(), s.astype(f"<u{width}").tobytes()])


class Shard:
    """A packed shard. `document(k)` decodes one document, `all()` every id."""

    def __init__(self, blob: bytes):
        mark, width, n, self.n_ids, n_rules, n_symbols, self.first = struct.unpack_from(HEAD, blob)
        if mark != MARK:
            raise ValueError("not a token shard")
        at = struct.calcsize(HEAD)

        def take(kind: str, size: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, size, at)
            at += out.nbytes
            return out

        self.doc_ids, self.no_id, self.sizes = take("<i8", n), take("u1", n).astype(bool), take("<u4", n)
        self.rules, self.lengths, self.symbols = take("<u4", 2 * n_rules).reshape(-1, 2), take("<u4", n_rules), take(f"<u{width}", n_symbols)
        self.starts = np.r_[0, np.cumsum(self.sizes, dtype=np.int64)]
        whole: list[np.ndarray] = []  # expansion of each nonterminal; a rule names earlier ones only
        for a, b in self.rules:
            whole.append(np.concatenate([whole[x - self.first] if x >= self.first else np.array([x], np.uint32) for x in (int(a), int(b))]))
        self.flat = np.concatenate([np.empty(0, np.uint32), *whole])
        self.flat_at = np.r_[0, np.cumsum(self.lengths, dtype=np.int64)]
        self.ends = np.cumsum(self._length(self.symbols), dtype=np.int64)

    def _length(self, s: np.ndarray) -> np.ndarray:
        out = np.ones(len(s), np.int64)
        k = np.flatnonzero(s >= self.first)
        out[k] = self.lengths[s[k] - self.first]
        return out

    def _expand(self, s: np.ndarray) -> np.ndarray:
        size = self._length(s)
        begin = np.r_[0, np.cumsum(size)]
        out = np.empty(begin[-1], np.uint32)
        lone = s < self.first
        out[begin[:-1][lone]] = s[lone]
        k = np.flatnonzero(~lone)
        n = size[k]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(begin[k], n) + step] = self.flat[np.repeat(self.flat_at[s[k] - self.first], n) + step]
        return out

    def all(self) -> np.ndarray:
        return self._expand(self.symbols)

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document; only the symbols that cover it are expanded."""
        a, b = int(self.starts[k]), int(self.starts[k + 1])
        i, j = np.searchsorted(self.ends, a, "right"), np.searchsorted(self.ends, b, "left")
        before = int(self.ends[i - 1]) if i else 0
        return self._expand(self.symbols[i:j + 1])[a - before:b - before]


# --- Tables ---

def write(docs: DataFrame, path: str | None = None, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode, compress and write the texts of docs (doc_id, text); the table of shards (part, seq, docs, ids, blob).

    Documents are in ascending order of doc_id (null first; rows of one id by a hash of their text) over parts and, in a
    part, over shards. Null and empty texts have the end id alone. A shard holds whole documents."""
    with open(path or default_path(), encoding="utf-8") as f:
        spec = f.read()

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, first = Encoder(spec), max(65536 - 16384, 0)
        first = max(first, coder.model.get_vocab_size(with_added_tokens=True))
        part, seq, held, n = 0, 0, [], 0

        def close() -> pd.DataFrame:
            return pd.DataFrame([(part, seq, len(held), n, pack(held, first))], columns=["part", "seq", "docs", "ids", "blob"])

        for pdf in batches:
            part = int(pdf["_part"].iloc[0]) if len(pdf) else part
            for at in range(0, len(pdf), 1024):
                block = pdf.iloc[at:at + 1024]
                ids = [None if null else int(x) for x, null in zip(block["_id"], block["_no"], strict=True)]
                for doc_id, x in zip(ids, coder.batch(block["_text"].tolist()), strict=True):
                    held.append((doc_id, np.r_[x, np.uint32(END_ID)]))
                    n += len(x) + 1
                    if n >= shard_ids:
                        yield close()
                        seq, held, n = seq + 1, [], 0
        if held:
            yield close()

    rows = docs.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("_id"), F.col("doc_id").isNull().alias("_no"),
                       F.coalesce("text", F.lit("")).alias("_text"))
    order = [F.col("_no").desc(), F.col("_id").asc(), F.xxhash64("_text").asc()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    return settle(rows.mapInPandas(shards, "part int, seq int, docs long, ids long, blob binary"), "token-shards")


def read(shards: DataFrame) -> DataFrame:
    """Per document, from the shards: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers). Starts come from sums over parts, then over a part's shards."""
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, seq, blob in zip(pdf["part"], pdf["seq"], pdf["blob"], strict=True):
                s = Shard(blob)
                raw = s.all().astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(s.starts[:-1].tolist(), s.starts[1:].tolist(), strict=True)]
                out = pd.DataFrame({"part": part, "seq": seq, "doc_id": pd.Series(s.doc_ids.astype("<i8")).astype("Int64").mask(pd.Series(s.no_id)),
                                    "local": s.starts[:-1], "n_tokens": s.sizes.astype(np.int64), "ids_crc32": np.array(crc, np.int64)})
                yield out

    sizes = shards.select("part", "seq", "ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_part_at"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(parts, "part").select("part", "seq", (F.col("_part_at") + F.coalesce(F.sum("ids").over(inside), F.lit(0))).alias("_at"))
    docs = shards.mapInPandas(decode, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["part", "seq"]).select("doc_id", (F.col("_at") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
