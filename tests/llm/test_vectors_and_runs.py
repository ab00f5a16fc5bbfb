"""Near-duplicate vectors, vector codes and periodic runs beside plain versions of them."""

import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from check import rows_of
from peakloom.llm import embedding_dedup, periodic_runs, queries, vector_codes

from . import brute

VECTORS = "vec_id long, embedding array<float>, label int, n_links string"


def test_lyndon_groups():
    draw = random.Random(1)
    for _ in range(600):
        x = [draw.randrange(draw.randint(1, 4)) for _ in range(draw.randint(0, 20))]
        length, group = periodic_runs.lyndon_groups(x)
        n = len(x)
        want = [max(k for k in range(1, n - i + 1) if all(x[i : i + k] < x[i + j : i + k] for j in range(1, k))) for i in range(n)]
        assert length == want
        roots = [tuple(x[i : i + k]) for i, k in enumerate(want)]
        assert all((group[i] == group[j]) == (roots[i] == roots[j]) for i in range(n) for j in range(i))


def plain_runs(x, least=24, ratio=3):
    n, out = len(x), []
    for p in range(1, n // ratio + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and x[i] == x[i + p]:
                i += 1
            size = i + p - start
            if size >= max(least, ratio * p) and not any(s <= start and s + k >= start + size for s, k, _ in out):
                out.append((start, size, p))
            i += 1
    return sorted(out)


def wordy(draw, n, k):
    out = []
    while len(out) < n:
        if draw.random() < 0.4:
            piece = [draw.randrange(k) for _ in range(draw.randint(1, 9))]
            out += piece * draw.randint(1, 6) + piece[: draw.randint(0, len(piece))]
        else:
            out.append(draw.randrange(k))
    return out


@pytest.mark.parametrize("least, ratio", [(2, 2), (4, 2), (6, 3), (24, 3), (9, 4)])
def test_runs_of_numbers(least, ratio):
    draw = random.Random(least)
    for _ in range(500):
        x = wordy(draw, draw.randint(0, 90), draw.randint(1, 5))
        assert periodic_runs.runs_of(x, least, ratio) == plain_runs(x, least, ratio), x


def test_extensions_of_long_runs():
    x = list(range(50)) + [7, 8, 9] * 40_000 + list(range(60, 90)) + list(range(5000)) * 3
    assert periodic_runs.runs_of(x) == [(50, 120_000, 3), (120_080, 15_000, 5000)]


def plain_rows(rows):
    out = []
    for doc, text in rows:
        words = brute.words(text)
        n, h = len(words), zlib.crc32(str(doc).encode())
        if doc is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words)
        gone = {i for s, k, p in runs for i in range(s + p, s + k)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
        out.append((doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None, brute.sha("".join("%d,%d,%d\n" % r for r in runs)), brute.sha(" ".join(w for i, w in enumerate(words) if i not in gone)), n))
    return out


def test_periodic_runs_of_documents(spark, tmp_path):
    draw = random.Random(3)
    rows = [(i, " ".join(f"w{v}" for v in wordy(draw, draw.randint(0, 150), draw.choice([1, 2, 9, 500])))) for i in range(150)]
    line = "one line that stands again and again é😀\n"
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, line * 30), (1003, line * 30), (1003, "a b"), (None, "x " * 24), (None, "x " * 23), (1004, "z" + "a b c " * 5000), (-5, "p q\x0br s\x0c" * 9)]
    schema = "doc_id long, text string, runs string, best int, `start` int, words int, g int"
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], schema).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    key = lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else v for v in r)
    found = sorted(map(tuple, got.collect()), key=key)
    assert found == sorted(plain_rows(rows), key=key)
    docs.filter("doc_id is not null and doc_id <> 1003").dropDuplicates(["doc_id"]).write.parquet(f"{tmp_path}/once.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/once.parquet/*.parquet'")
    cur = con.execute(periodic_runs.runs_sql())
    once = got.filter("doc_id is not null and doc_id <> 1003")
    assert rows_of(got.columns, once.collect()) == rows_of([d[0] for d in cur.description], cur.fetchall())
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def clusters(draw, count, near, dim=64):
    """Random vectors, some with many noisy copies, and pairs at either side of the threshold."""
    rows = [draw.normal(size=dim) for _ in range(count)]
    for centre, copies in near:
        rows += [rows[centre] / np.linalg.norm(rows[centre]) * draw.uniform(0.1, 9) + draw.normal(size=dim) * draw.uniform(0, 0.03) for _ in range(copies)]
    for k in range(60):
        a, b = rows[k] / np.linalg.norm(rows[k]), draw.normal(size=dim)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        cos = 0.945 + 0.0002 * k
        rows.append(a * cos + b * np.sqrt(1 - cos * cos))
    return rows


def plain_links(rows, least=0.95):
    """{row number: links}, {row number: component} over rows (vec_id, vector)."""
    fit = [i for i, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = set()
    for dim in {len(rows[i][1]) for i in fit}:
        mine = [i for i in fit if len(rows[i][1]) == dim]
        x = np.array([np.float32(rows[i][1]) for i in mine], np.float64)
        x /= np.abs(x).max(axis=1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, b in np.argwhere(np.triu(x @ x.T >= least, 1)):
            pairs.add((mine[a], mine[b]))
            links[mine[a]] += 1
            links[mine[b]] += 1
            root[find(mine[a])] = find(mine[b])
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return links, [min((v for v in groups[find(i)] if v is not None), default=None) for i in range(len(rows))], len(pairs)


def test_near_vectors_and_blocks(spark):
    draw = np.random.default_rng(5)
    rows = [(1000 + i, v.astype(np.float32).tolist()) for i, v in enumerate(clusters(draw, 300, [(0, 260), (1, 90), (2, 12), (3, 1), (3, 1)]))]
    rows += [(7, rows[20][1]), (8, rows[20][1]), (8, rows[20][1]), (9, [0.0] * 64), (10, None), (11, [1.0, None]), (12, [float("nan")] * 64), (13, []), (14, [1.0, 2.0]), (15, [2.0, 4.0]), (16, [1e-40, 2e-40]), (17, [1e38, 2e38, 0.0])]
    draw.shuffle(rows)
    links, roots, pairs = plain_links(rows)
    want = {}
    for (vec, _), n, root in zip(rows, links, roots):
        want.setdefault(int(vec), []).append((n, root))
    table = spark.createDataFrame([(int(v), e, 1, "x") for v, e in rows], VECTORS).repartition(3)
    found = None
    for crowd, block in [(256, 4096), (30, 25)]:
        got = embedding_dedup.near_duplicates(table, crowd=crowd, block=block).collect()
        out = {}
        for r in got:
            out.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"]))
            assert r["kept"] == (r["vec_id"] == r["component_id"])
        out = {v: sorted(x) for v, x in out.items()}
        # Neither setting changes what is found; clumps may link what no table met.
        assert found is None or sum(n for x in out.values() for n, _ in x) >= 0.99 * sum(n for x in found.values() for n, _ in x)
        found = out
        assert set(out) == set(want) and all(len(out[v]) == len(want[v]) for v in want)
        assert all(a[0] <= b[0] for v in want for a, b in zip(out[v], sorted(want[v])))
        assert sum(n for x in out.values() for n, _ in x) >= 0.97 * 2 * pairs
        assert out[8] == sorted(want[8]) and out[7] == want[7] and {v: out[v] for v in range(9, 18)} == {v: want[v] for v in range(9, 18)}
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


def test_near_vectors_at_the_threshold(spark):
    rows = [(1, [1.0, 0, 0, 0, 0]), (2, [19.0, 6, 1, 1, 1]), (3, [18.99, 6, 1, 1, 1]), (None, [0, 0, 0, 0, 3.0]), (None, [0, 0, 0, 0, 1.0])]
    got = embedding_dedup.near_duplicates(spark.createDataFrame([(v, [float(x) for x in e]) for v, e in rows], "vec_id long, embedding array<double>"), recall=0.9999999)
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got.collect()} == {(1, 1, 1, True), (2, 2, 1, False), (3, 1, 1, False), (None, 1, None, True)}


def test_recall_at_the_threshold(spark):
    draw = np.random.default_rng(9)
    rows = []
    for k in range(400):
        a, b = draw.normal(size=64), draw.normal(size=64)
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist()), (2 * k + 1, (a * 0.9501 + b * np.sqrt(1 - 0.9501**2)).tolist())]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.filter("n_links > 0").count() >= 0.92 * 800


def test_forest_keeps_components():
    draw = np.random.default_rng(2)
    for _ in range(200):
        linked = draw.random((draw.integers(1, 12), draw.integers(1, 12))) < draw.choice([0.05, 0.15, 0.5])
        r, c = embedding_dedup._forest(linked)
        assert linked[r, c].all()

        def parts(edges):
            root = list(range(sum(linked.shape)))

            def find(i):
                while root[i] != i:
                    i = root[i]
                return i

            for a, b in edges:
                root[find(a)] = find(len(linked) + b)
            return {tuple(j for j in range(len(root)) if find(j) == find(i)) for i in range(len(root))}

        assert parts(zip(r.tolist(), c.tolist())) == parts(np.argwhere(linked).tolist())


def plain_codes(rows, parts=16, entries=64, rounds=2):
    fit = [r for r in rows if r[1] is not None and len(r[1]) and all(x is not None and np.isfinite(x) for x in r[1])]
    fit.sort(key=lambda r: (r[0] is None, r[0] or 0, [float(x) for x in r[1]]))
    fit = [r for r in fit if len(r[1]) == len(fit[0][1])]
    wide = -(-len(fit[0][1]) // parts)
    whole = [[int(np.floor(float(np.float32(x)) * 256)) for x in r[1]] + [0] * (wide * parts - len(r[1])) for r in fit]
    cut = [[tuple(w[p * wide : p * wide + wide]) for p in range(parts)] for w in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    assign = lambda: [[min((far(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]
    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, g in zip(cut, got) if g[p][1] == k]
                if mine:
                    books[p][k] = tuple(sum(x) // len(mine) for x in zip(*mine))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    got = assign()
    error = [sum(d for d, _ in g) for g in got]
    sums = {}
    for r, e in zip(fit, error):
        sums[r[2]] = sums.get(r[2], 0) + e
    return [(r[0], "".join(f"{k:02x}" for _, k in g), e, sums[r[2]], digest) for r, g, e in zip(fit, got, error)]


@pytest.mark.parametrize("dim, many", [(64, 120), (50, 90), (8, 30), (64, 1)])
def test_vector_codes(spark, tmp_path, dim, many):
    draw = np.random.default_rng(dim)
    rows = [(int(i), (draw.integers(-3, 4, dim) * draw.choice([0.01, 0.25, 300.0])).astype(np.float32).tolist(), draw.choice([None, 1, 2])) for i in range(many)]
    rows += [rows[-1], (3, rows[0][1], None), (None, rows[0][1], 1), (500, None, 1), (501, [float("inf")] * dim, 1), (502, [None] * dim, 2), (503, [1.0] * (dim + 1), 2), (504, [], 2)]
    table = spark.createDataFrame([(v, e, None if k is None else int(k), "x") for v, e, k in rows], VECTORS).repartition(3)
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.QUERIES["op12_vector_codes"](spark, str(tmp_path))
    assert rows_of(got.columns, got.collect()) == rows_of(got.columns, plain_codes(rows))
    assert vector_codes.compress(table.limit(0)).count() == 0


def test_nearest_entries_of_deep_tries(monkeypatch):
    draw = np.random.default_rng(1)
    monkeypatch.setattr(vector_codes, "BLOCK", 3)
    for _ in range(50):
        part = draw.integers(-4, 4, (draw.integers(1, 200), draw.integers(1, 5)))
        book = draw.integers(-4, 4, (draw.integers(1, 9), part.shape[1]))
        leaves, weight, place = vector_codes._trie(part)
        entry, distance = vector_codes.nearest(leaves, book)
        far = ((part[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (leaves[place] == part).all() and weight.sum() == len(part)
        assert (entry[place] == far.argmin(axis=1)).all() and (distance[place] == far.min(axis=1)).all()


def test_components_beyond_the_bound(spark):
    table = spark.createDataFrame([(1, [3e38] * 64, 1), (2, [-3e38] * 64, 1), (3, [1.0] * 64, None)], "vec_id long, embedding array<float>, label int")
    assert [r["error"] for r in vector_codes.compress(table, entries=1, rounds=0).orderBy("vec_id").collect()] == [0, 64 * 2**56, 64 * (2**27 - 256) ** 2]
