"""Product codes against brute force and SQL."""

import hashlib
import random

import duckdb
import numpy as np

from geoweave.llm import vector_codes as vc


def brute(rows, parts=4, entries=256, rounds=4):
    """rows: (id, vector, label). Plain Python, all distances."""
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    kept = sorted(((i, v + [0] * (parts * width - len(v)), label) for i, v, label in kept), key=lambda r: (r[0] is None, r[0] or 0))
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def closest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for c in cut:
                own.setdefault(closest(c[p], books[p])[1], []).append(c[p])
            for n, members in own.items():
                books[p][n] = [sum(x) // len(members) for x in zip(*members)]
    out, errors = [], {}
    for (i, _, label), c in zip(kept, cut):
        found = [closest(c[p], books[p]) for p in range(parts)]
        out.append([i, "".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found), label])
        errors[label] = errors.get(label, 0) + out[-1][2]
    said = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted([(i, code, error, errors[label], said) for i, code, error, label in out], key=str)


def got(df, **options):
    return sorted([tuple(r) for r in vc.code_report(vc.compress(df, **options)).collect()], key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_whole_table_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = sorted([tuple(r) for r in con.execute(vc.REPORT_SQL).fetchall()], key=str)
    assert got(spark.read.parquet(f"{sf_dir}/embeddings.parquet")) == want


def test_brute_force_with_ties_and_small_integers(spark):
    rng = random.Random(1)
    rows = [(n, [rng.randint(-2, 2) / 1024 for _ in range(12)], rng.choice([None, 1, 2])) for n in range(60)]
    assert got(frame(spark, rows), entries=7, rounds=3) == brute(rows, entries=7, rounds=3)


def test_clustered_vectors_of_odd_lengths(spark):
    rng = random.Random(2)
    centres = [[rng.gauss(0, 1) for _ in range(37)] for _ in range(6)]
    rows = [(n, [x + rng.gauss(0, 0.05) for x in rng.choice(centres)][: rng.choice([37, 37, 30])], n % 3) for n in range(80)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert got(frame(spark, rows), entries=9) == brute(rows, entries=9)


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(3)
    for width in (1, 2, 5, 16, 50):
        for scale in (1, 300, vc.LIMIT):
            rows = rng.integers(-scale, scale + 1, (40, width))
            rows[:5] = rows[5:10]
            rows[10:15] = rows[10:15, :1]
            levels = vc.levels_of(width)
            own = vc.Parts(rows, levels)
            true = ((rows[:, None].astype(object) - rows[None]) ** 2).sum(axis=2)
            for level in own.levels:
                found = vc.lower_bounds(level[:, None], level[None], own.squares[:, None], own.squares[None])
                assert (found <= true.astype(float)).all()
            index, least = vc.nearest(rows, own)
            assert index.tolist() == [min(range(40), key=lambda j, i=i: (true[i, j], j)) for i in range(40)] and not least.any()


def test_filter_leaves_few_entries_for_exact_distances():
    rng = np.random.default_rng(4)
    centres = rng.integers(-4000, 4000, (64, 1)) + rng.integers(-50, 50, (64, 16))
    own, book = vc.Parts(centres.repeat(4, axis=0) + rng.integers(-9, 9, (256, 16)), [1, 4]), vc.Parts(centres, [1, 4])
    bounds = vc.lower_bounds(own.levels[0][:, None], book.levels[0][None], own.squares[:, None], book.squares[None])
    exact = ((own.rows[:, None] - book.rows[None]) ** 2).sum(axis=2)
    assert (bounds <= exact.min(axis=1)[:, None]).mean() < 0.2


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, -0.5, 0.25, 0.0], None), (1, [1.0, -0.5, 0.25, 0.0], None), (None, [0.1, 0.2], 3), (2, None, 3), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [inf, 0.0], 1), (5, [None, 1.0], 1), (6, [], 4), (7, [3e38, -3e38, 0.0, 0.0], 5)]
    df = frame(spark, rows).selectExpr("*", "'x' AS id", "1 AS code", "2 AS error", "3 AS of_label")
    found = got(df)
    assert [r[0] for r in found] == [1, 1, 6, 7, None]
    assert all(r[2] == r[3] == 0 for r in found)
    assert got(df.where("vec_id = 2")) == [] and got(df.limit(0)) == []


def test_hot_and_many_labels(spark):
    coded = spark.createDataFrame([(n, None if n % 3 == 0 else n % 40, "00", n) for n in range(500)], "id long, label int, code string, error long")
    want = {}
    for r in coded.collect():
        want[r.label] = want.get(r.label, 0) + r.error
    for hot, most in ((1_000_000, 1000), (20, 5), (1, 0)):
        rows = vc.with_label_errors(coded, hot, most).collect()
        assert len(rows) == 500 and all(r.label_error == want[r.label] for r in rows)


def test_codes_stand_for_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(n, [float(x) for x in np.float32(rng.normal(size=8))], None) for n in range(20)]
    found = vc.integers(frame(spark, rows))
    books = vc.fit(found, entries=256)
    for r in vc.encode(found, books).collect():
        assert np.abs(vc.decode(r.code, books) - np.array(rows[r.id][1])).max() <= 1 / 1024 + 1e-9
