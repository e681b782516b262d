"""SentencePiece encoding and decoding by a streaming Viterbi search over the pieces of a public model.

The search goes over the text once and keeps, for each boundary, the best last piece and thus a path back. Pieces reach at most
the longest piece's length beyond the character in hand, and that is the window. As soon as the paths back from all boundaries
that a further piece can start from run through one boundary, everything before it is committed and forgotten.

For BPE models a step from one piece to the next counts only if the pair is stable: encoding its two pieces as one string by
merges gives the same two pieces. Each boundary then has one path, and it spells the ids that the merges of the library give.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from meadow.llm.common import worker_memory

SPACE = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CACHE = 400_000  # entries of a worker's memories of steps, of which there are two, and of pairs, which is emptied when full
LONGEST_STEP = 64  # characters of a step that is remembered
SLICE = 64  # texts that are encoded before their rows leave the task


class Pieces:
    """Pieces of a BPE model with byte fallback; stands on the model's bytes, so that it travels to the tasks."""

    def __init__(self, proto: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.scores: dict[str, float] = {}
        self.names: list[str | bytes] = []
        self.byte_ids = [0] * 256
        self.trie: dict = {}  # a node has a node per next character and, under 0, the id of the piece that ends there or -1
        for i in range(sp.vocab_size()):
            name = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
                self.names.append(bytes([int(name[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.names.append("")
            else:
                self.scores[name] = sp.get_score(i)
                self.names.append(name)
                node = self.trie
                for c in name:
                    node = node.setdefault(c, {0: -1})
                node[0] = i
        self.spelled = [n if isinstance(n, bytes) else n.replace(SPACE, " ").encode() for n in self.names]
        self.longest = max(map(len, self.scores))
        self.stable: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}  # steps from before `known` was full; those that come again move over
        # If no piece goes on with a space after another character, all paths meet at every word start: a step ends there.
        self.cut = not any(SPACE in name.lstrip(SPACE) for name in self.scores)
        self.step = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.commits = self.searched = self.held = 0  # commits, searched steps and the most characters between two commits so far

    def merged(self, s: str) -> list[str]:
        """Pieces of a short string by merges: the best-scored neighbours first, the leftmost of equals."""
        parts = list(s)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                v = self.scores.get(parts[i] + parts[i + 1])
                if v is not None and (best is None or v > best):
                    best, at = v, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, a: int, b: int) -> bool:
        """Whether piece b may stand after piece a, both by id."""
        if len(self.stable) >= CACHE:
            self.stable.clear()
        x, y = self.names[a], self.names[b]
        got = self.stable[a << 24 | b] = self.merged(x + y) == [x, y]
        return got

    def search(self, chunks: Iterable[str], first: int = -1) -> Iterator[int]:
        """Ids of a text that comes in chunks, each as soon as it is certain; `first` is the id before them, -1 if none."""
        window = _Window(self, first)
        for chunk in chunks:
            window.text += chunk
            yield from window.advance(len(window.text) - self.longest)
            window.forget()
        yield from window.advance(len(window.text), True)

    def stream(self, chunks: Iterable[str]) -> Iterator[Iterable[int]]:
        """Ids of a text that comes in chunks (spaces already written as the space mark), some at a time, as soon as they are certain.

        Where the model lets all paths meet at word starts, a word is one step of the search from one such boundary to the next;
        a step taken before is looked up, others are searched. A step waits in the buffer until its end is there."""
        if not self.cut:
            yield self.search(chunks)
            return
        rest = ""
        for chunk in chunks:
            steps = self.step.findall(rest + chunk)
            rest = steps.pop() if steps else ""
            for w in steps:
                yield self.known.get(w) or self._taken(w)
        if rest:
            yield self.known.get(rest) or self._taken(rest)

    def _taken(self, w: str) -> Iterable[int]:
        """A step that is searched; a long one is not remembered."""
        if len(self.known) >= CACHE:
            self.older, self.known = self.known, {}
        got = self.older.get(w)
        if got is None:
            self.searched += 1
            window = _Window(self, -1)
            window.text = w
            got = tuple(window.advance(len(w), True))
            if len(w) > LONGEST_STEP:
                return got
        self.known[w] = got
        return got

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text."""
        out: list[int] = []
        for ids in self.stream([SPACE + text.replace(" ", SPACE)] if text else []):
            out += ids
        return np.array(out, np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids. Space marks become spaces, the leading one goes; invalid bytes become replacement characters."""
        out = b"".join([self.spelled[i] for i in ids])
        text = out.decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


class _Window:
    """The search of one text. `base` is the last committed boundary and `text` begins at or before it; for a boundary b after it
    back[b] is the length of the piece that ends there on the only path to it (0: no path), last[b] that piece's id (-1: a
    character that is no piece, which merges with nothing). Pieces that start before `at` are all in; none goes beyond `far`."""

    def __init__(self, model: Pieces, first: int):
        self.model, self.text = model, ""
        self.base = self.at = self.far = 0
        self.back, self.last = [0], [first]

    def advance(self, stop: int, final: bool = False) -> list[int]:
        """Takes in the pieces that start before `stop`, which lies a piece's length before the end of the text or, if that is
        final, at its end; returns the ids that have become certain."""
        model, chars, back, last = self.model, list(self.text), self.back, self.last
        root, stable, follows = model.trie.get, model.stable.get, model.follows
        n, longest = len(chars), model.longest
        grow = n + 1 - len(back)
        back.extend([0] * grow)
        last.extend([-1] * grow)
        base, at, far, out = self.base, self.at, self.far, []
        while at < stop:
            if at > base:
                if far <= at:  # no piece goes over this boundary: all paths meet here
                    self._commit(base, at, out)
                    base = at
                elif at - base > longest:
                    meet = self._meet(at, far)
                    if meet > base:
                        self._commit(base, meet, out)
                        base = meet
                    elif at - base > model.held:
                        model.held = at - base
                if not back[at] and at > base:
                    at += 1
                    continue
            prev = last[at]
            end = at + 1
            node = root(chars[at])
            if (node is None or node[0] < 0) and not back[end]:
                back[end] = 1
            if far < end:
                far = end
            while node is not None:
                i = node[0]
                if i >= 0:
                    if far < end:
                        far = end
                    if not back[end]:
                        ok = True if prev < 0 else stable(prev << 24 | i)
                        if ok is None:
                            ok = follows(prev, i)
                        if ok:
                            back[end], last[end] = end - at, i
                if end == n:
                    break
                node = node.get(chars[end])
                end += 1
            at += 1
        if final and n > base:
            self._commit(base, n, out)
            base = n
        self.base, self.at, self.far = base, at, far
        return out

    def _commit(self, base: int, end: int, out: list[int]) -> None:
        """Adds the ids of the path from base to end."""
        model, back, last = self.model, self.back, self.last
        model.commits += 1
        if end - base > model.held:
            model.held = end - base
        first = len(out)
        while end > base:
            if last[end] >= 0:
                out.append(last[end])
            else:
                out.extend(model.byte_ids[b] for b in reversed(self.text[end - 1:end].encode("utf-8", "replace")))
            end -= back[end]
        out[first:] = out[:first - 1 if first else None:-1] if first < len(out) else []

    def _meet(self, at: int, far: int) -> int:
        """The last boundary on the paths of all that a further piece can start from."""
        paths = {b for b in range(at, far + 1) if self.back[b]}
        while len(paths) > 1:
            high = max(paths)
            paths.remove(high)
            paths.add(high - self.back[high])
        return paths.pop()

    def forget(self) -> None:
        """Drops what lies before the last commit."""
        base = self.base
        self.text, self.back, self.last = self.text[base:], self.back[base:], self.last[base:]
        self.at, self.far, self.base = self.at - base, self.far - base, 0


def load(path: str = MODEL) -> bytes:
    """The model's bytes, read once by the driver."""
    with open(path, "rb") as f:
        return f.read()


def _model(proto: bytes) -> Pieces:
    """One model per worker process, with what it remembers."""
    return worker_memory(f"pieces {hashlib.sha256(proto).hexdigest()}", lambda: Pieces(proto))


def encode(docs: DataFrame, proto: bytes, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds `out`, the ids (array<int>) of each whole text. Null and empty texts have no ids; all rows and columns stay.

    The space mark in a text is read as a space. A column that has the name `out` already is replaced."""
    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _model(proto)
        for texts in batches:
            yield pd.Series([model.encode(t) for t in texts], index=texts.index, dtype=object)

    return docs.withColumn(out, run(text))


def decode(rows: DataFrame, proto: bytes, ids: str = "ids", out: str = "text") -> DataFrame:
    """Adds `out`, the text of each row's ids; null ids have an empty text."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _model(proto)
        for many in batches:
            yield pd.Series([model.decode(x.tolist()) if x is not None else "" for x in many], index=many.index, dtype=object)

    return rows.withColumn(out, run(ids))


def round_trip(docs: DataFrame, proto: bytes, with_ids: bool = True) -> DataFrame:
    """All columns but `text`, then ids (array<int>, where wanted), n_ids, ids_sha256 (ids joined by commas), decoded_sha256, round_trip.

    A worker encodes, decodes and digests a few texts at a time and hands their rows on, so that ids cross to the JVM at most once.
    Null and empty texts have no ids and round-trip as the empty text; rows that repeat stay; an empty table gives no rows; other
    columns pass through, those that have the name of a new one are replaced."""
    new = [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    new += [T.StructField("n_ids", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
            T.StructField("round_trip", T.BooleanType())]
    taken = {f.name for f in new} | {"ids", "text"}
    kept = [f for f in docs.schema.fields if f.name not in taken]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(proto)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                coded = [model.encode(t) for t in texts]
                lists = [c.tolist() for c in coded]
                decoded = [model.decode(c) for c in lists]
                sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
                ends = np.cumsum([0, *map(len, coded)])
                ids = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(coded), pa.int32()))] if with_ids else []
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(part.schema.get_field_index(n)) for n in names], *ids, pa.array(np.diff(ends), pa.int64()),
                     pa.array([sha(",".join(map(str, c))) for c in lists]), pa.array([sha(d) for d in decoded]),
                     pa.array([d == t for d, t in zip(decoded, texts, strict=True)])], names=[*names, *[f.name for f in new]])

    return docs.select(*names, "text").mapInArrow(run, T.StructType([*kept, *new]))


def digests(docs: DataFrame, proto: bytes) -> DataFrame:
    """Per document row: doc_id, n_ids, ids_sha256, decoded_sha256, round_trip, as in round_trip(). Other columns are ignored."""
    return round_trip(docs.select("doc_id", "text"), proto, with_ids=False)
