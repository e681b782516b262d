"""Vector codes, hard negatives and hash-tree sharding against plain Python, with odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from meadow.llm import exact, hard_negatives, hash_tree, vector_codes

VECTORS = "vec_id long, label int, embedding array<float>, q string, code int, tile int, block int, anchor string, rank int, error int"
EXTRA = ("x", 1, 2, 3, "y", 4, 5)


def floors(vector, scale):
    return [math.floor(scale * float(np.float32(x))) for x in vector]


@pytest.fixture(scope="module")
def vectors():
    r = random.Random(7)
    rows = [(i * 5 - 20, r.choice([0, 1, 2, 3, 3, 3]), [r.gauss(0, 0.4) for _ in range(16)]) for i in range(400)]
    rows += [(5000 + i, 3, rows[2][2]) for i in range(60)] + [(7000, None, rows[3][2]), (7050, 1, None), (7100, 1, [*[0.5] * 15, None]),
             (7150, 2, [*[0.5] * 15, float("nan")]), (7200, 2, [*[0.5] * 15, float("inf")]), (7250, 0, [0.0] * 16), (7300, 1, [-900.0] * 16)]
    return rows + [rows[10], rows[10], (0, 9, rows[7][2])]


@pytest.fixture(scope="module")
def frame(spark, vectors):
    return spark.createDataFrame([(*v, *EXTRA) for v in vectors], VECTORS).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], VECTORS)


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


# --- Exact products ---

def test_limb_products_are_exact():
    g = np.random.default_rng(1)
    for top in (1, 200, 1 << 12, 1 << 25, 1 << 28):
        a, b = g.integers(-top, top, (7, 33), endpoint=True), g.integers(-top, top, (5, 33), endpoint=True)
        assert (exact.dot(a, b) == np.array([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a])).all()
        assert (sum(p.astype(np.int64) << (exact.LIMB * i) for i, p in enumerate(exact.limbs(a))) == a).all()
        assert all(np.abs(p).max() <= 1 << exact.LIMB for p in exact.limbs(a))
    assert exact.dot(np.zeros((0, 3), np.int64), b[:, :3]).shape == (0, 5)


# --- 11 Vector codes ---

def plain_codes(rows, parts, entries, rounds):
    kept = sorted(((v[0], floors(v[2], 4096), v[1]) for v in rows if good(v[2])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    part = lambda q, p: q[p * size:(p + 1) * size]
    books = [[part(q, p) for _, q, _ in kept[:entries]] for p in range(parts)]
    apart = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    find = lambda x, book: min(range(len(book)), key=lambda e: (apart(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for _, q, _ in kept:
                held[find(part(q, p), books[p])].append(part(q, p))
            for e, xs in held.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out = []
    for i, q, label in kept:
        at = [find(part(q, p), books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{e:02x}" for e in at), sum(apart(part(q, p), books[p][e]) for p, e in enumerate(at))))
    total = Counter()
    for _, label, _, error in out:
        total[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, code, error, total[label], digest) for i, label, code, error in out)


def test_vector_codes_match_plain_integers(spark, frame, vectors, none, monkeypatch):
    want = plain_codes(vectors, 8, 16, 6)
    got = vector_codes.code_report(frame)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, got.collect())) == want
    monkeypatch.setattr(vector_codes, "HOT", 3)  # most labels go by shuffle
    assert Counter(map(tuple, vector_codes.code_report(frame.repartition(1)).collect())) == want
    few = [(None, None, [1.0, -2.0]), (None, None, [1.0, -2.0]), (4, 1, [0.5, 0.25])]
    small = spark.createDataFrame(few, "vec_id long, label int, embedding array<float>")
    assert Counter(map(tuple, vector_codes.code_report(small, parts=2).collect())) == plain_codes(few, 2, 16, 6)
    assert vector_codes.code_report(none).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.code_report(small, parts=8)
    with pytest.raises(ValueError, match="components"):
        vector_codes.code_report(small.union(spark.createDataFrame([(9, 1, [1.0])], small.schema)), parts=1)
    with pytest.raises(ValueError, match="below"):
        vector_codes.code_report(spark.createDataFrame([(9, 1, [1e30])], small.schema), parts=1)


def test_codes_decode_to_their_entries(frame):
    coded, books = vector_codes.encode(frame, rounds=2)
    rows = {(r["vec_id"], r["code"]): r["vector"] for r in vector_codes.decode(coded, books).collect()}
    for (_, code), vector in list(rows.items())[:50]:
        at = [int(code[2 * p:2 * p + 2], 16) for p in range(8)]
        assert [x * 4096 for x in vector] == [x for p, e in enumerate(at) for x in books[p][e]]


# --- 12 Hard negatives ---

def test_hilbert_steps_change_one_cell_by_one():
    for axes, depth in ((2, 3), (3, 3), (4, 2)):
        side = 1 << depth
        cells = np.stack(np.meshgrid(*[np.arange(side)] * axes, indexing="ij"), -1).reshape(-1, axes)
        at = hard_negatives.hilbert(cells, depth)
        assert sorted(at.tolist()) == list(range(side ** axes))
        assert (np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(1) == 1).all()


def plain_mine(rows, every, positives=5, negatives=3):
    kept = {}
    for i, label, v in sorted((i, label, floors(v, 256)) for i, label, v in rows if i is not None and label is not None and good(v)):
        kept.setdefault(i, (label, v))
    out = []
    for a in (i for i in kept if i % every == 0):
        label, q = kept[a]
        score = {i: sum(x * y for x, y in zip(q, v)) for i, (_, v) in kept.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if kept[i][0] == label][:positives]:
            hard = [i for i in order if kept[i][0] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]][:negatives]
            out += [(a, p, k, n, score[p], score[n]) for k, n in enumerate(hard, 1)]
    return Counter(out)


@pytest.mark.parametrize(("block", "tile", "page"), [(1024, 256, 256), (16, 8, 4)])
def test_hard_negatives_match_brute_force(frame, vectors, none, monkeypatch, block, tile, page):
    for name, value in (("BLOCK", block), ("TILE", tile), ("PAGE", page)):
        monkeypatch.setattr(hard_negatives, name, value)
    want = plain_mine(vectors, 10)
    got = hard_negatives.mine(frame, frame["vec_id"] % 10 == 0)
    assert Counter(map(tuple, got.collect())) == want and len(want) > 200
    assert hard_negatives.mine(none, none["vec_id"] % 10 == 0).count() == 0
    assert hard_negatives.mine(frame, frame["vec_id"] == 123456).count() == 0


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    """Far-apart clusters: most blocks cannot hold a result, and the result is still whole."""
    for name, value in (("BLOCK", 32), ("TILE", 64)):
        monkeypatch.setattr(hard_negatives, name, value)
    g = np.random.default_rng(2)
    centres = g.normal(0, 1, (20, 8))
    rows = [(i, int(g.integers(0, 3)), (centres[i % 20] + g.normal(0, 0.02, 8)).tolist()) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    seen, choose = [], hard_negatives.choose

    def counted(tiles, pages, buckets, width, same):
        units = choose(tiles, pages, buckets, width, same).cache()
        seen.append(sum(bin(int.from_bytes(r["mask"], "big")).count("1") for r in units.collect()))
        return units

    monkeypatch.setattr(hard_negatives, "choose", counted)
    assert Counter(map(tuple, hard_negatives.mine(df, df["vec_id"] % 50 == 0).collect())) == plain_mine(rows, 50)
    assert seen[0] < 0.2 * 40 * 2000 / 32


def test_bounds_hold():
    g = np.random.default_rng(3)
    x, rows = g.integers(-200, 200, (20, 9)), g.integers(-200, 200, (50, 9))
    low, high = hard_negatives.bounds(x, rows.min(0)[None], rows.max(0)[None])
    score = x @ rows.T
    assert (low[:, 0] <= score.min(1)).all() and (high[:, 0] >= score.max(1)).all()


# --- 13 Hash tree ---

DOCS = "doc_id long, text string, shard string, slot string, size string, _deal int, _part int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, "é" * (i % 50), "s", "t", "u", 1, 2) for i in range(3000)] + [(None, t, "s", "t", "u", 1, 2) for t in ("", None, "x", "x" * 200000)]
    return spark.createDataFrame(rows + rows[:4] + rows[:1] * 500, DOCS).repartition(6).cache()


def plain_shard(doc_id, tree):
    key = "" if doc_id is None else str(doc_id)

    def won(nodes):
        draw = lambda n: -math.log((int(hashlib.md5(f"{key}/{n[0]}".encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13) / n[1]
        return min(nodes, key=draw)[2]

    number, regions = 0, []
    for r, region in enumerate(tree):
        racks = []
        for k, rack in enumerate(region):
            racks.append((f"{r}/{k}", sum(rack), [(f"{r}/{k}/{s}", w, number + s) for s, w in enumerate(rack) if w]))
            number += len(rack)
        regions.append((str(r), sum(x[1] for x in racks), [x for x in racks if x[1]]))
    return won(won(won([x for x in regions if x[1]])))


def test_hash_tree_report(spark, docs):
    got = hash_tree.assignment(docs).collect()
    given = docs.select("doc_id", "text").collect()
    crc = lambda t: zlib.crc32((t or "").encode())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((d, len((t or "").encode()) + 1, crc(t)) for d, t in given)
    grown = hash_tree.grow(hash_tree.EIGHT)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert (r["shard"], r["grown_shard"]) == (plain_shard(r["doc_id"], hash_tree.EIGHT), plain_shard(r["doc_id"], grown))
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 8)
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 0.05 < sum(r["grown_shard"] == 8 for r in got) / len(got) < 0.2
    assert Counter(map(tuple, hash_tree.assignment(docs.repartition(1)).collect())) == Counter(map(tuple, got))
    assert hash_tree.assignment(docs.limit(0)).count() == 0


def test_movement_stays_in_subtrees_whose_weights_change(docs):
    """Weights follow, and neither regions nor racks of equal weight exchange rows."""
    before = [[[1.0, 2.0], [1.0, 0.0]], [[3.0], [1.0, 1.0]], [[2.0, 1.0]]]
    after = [[[1.0, 2.0], [1.0, 4.0]], [[3.0], [1.0, 1.0]], [[2.0, 1.0]]]
    home = {0: (0, 0), 1: (0, 0), 2: (0, 1), 3: (0, 1), 4: (1, 0), 5: (1, 1), 6: (1, 1), 7: (2, 0), 8: (2, 0)}
    ids = docs.filter("doc_id is not null").select("doc_id").distinct()
    a = {r["doc_id"]: r["shard"] for r in hash_tree.place(ids, before).collect()}
    b = {r["doc_id"]: r["shard"] for r in hash_tree.place(ids, after).collect()}
    share = Counter(a.values())
    assert 3 not in share and abs(share[4] / len(a) - 3 / 12) < 0.04 and abs(share[1] / len(a) - 2 / 12) < 0.04
    moved = [(a[d], b[d]) for d in a if a[d] != b[d]]
    assert moved
    for x, y in moved:
        assert home[y][0] == 0  # only into the region that grew
        if home[x][0] == 0:
            assert home[y] == (0, 1)  # inside it only into the rack that grew
    with pytest.raises(ValueError):
        hash_tree.place(ids, [[[0.0]]])


def test_shards_are_written_whole(spark, docs):
    back = spark.read.parquet(hash_tree.write_shards(docs))
    assert back.count() == docs.count()
    got = Counter((r["doc_id"], r["text"], r["shard"]) for r in back.select("doc_id", "text", "shard").collect())
    assert got == Counter((d, t, plain_shard(d, hash_tree.EIGHT)) for d, t in docs.select("doc_id", "text").collect())
