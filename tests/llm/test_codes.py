"""Op 12 against brute force, and its tree against full comparison."""

import hashlib

import numpy as np
import pytest

from battlelake.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows):
    """code, error, label_error, digest of each row that takes part; whole numbers without bounds."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    out = {}
    for dims in {len(r[1]) for r in rows}:
        own = [r for r in rows if len(r[1]) == dims]
        whole = [[int(np.floor(256 * float(x))) for x in r[1]] for r in own]
        edges = [p * dims // 16 for p in range(17)]
        parts = [[v[a:b] for v in whole] for a, b in zip(edges, edges[1:])]
        order = sorted((i for i, r in enumerate(own) if r[0] is not None), key=lambda i: (own[i][0], own[i][1]))[:64]
        books = [[part[i] for i in order] for part in parts]
        distance = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
        near = lambda: [[min((distance(x, e), k) for k, e in enumerate(book)) for x in part] for part, book in zip(parts, books)]
        for _ in range(2):
            found = near()
            for p, book in enumerate(books):
                for k in range(len(book)):
                    mine = [x for x, (_, e) in zip(parts[p], found[p]) if e == k]
                    if mine:
                        book[k] = [sum(column) // len(mine) for column in zip(*mine)]
        found = near()
        digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
        for i, r in enumerate(own):
            out.setdefault(id(r), ("".join(f"{found[p][i][1]:02x}" for p in range(16)), sum(found[p][i][0] for p in range(16)), digest))
    totals = {}
    for r in rows:
        totals[r[2]] = totals.get(r[2], 0) + out[id(r)][1]
    return sorted(((r[0], *out[id(r)][:2], totals[r[2]], out[id(r)][2]) for r in rows), key=str)


def random_rows(rng, n, dims, spread=1.0):
    return [(i, [float(np.float32(rng.gauss(0, spread))) for _ in range(dims)], rng.choice([None, 1, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("name", ["plain", "odd", "few", "ties", "large", "uneven"])
def test_report_equals_brute_force(spark, rng, name):
    rows = random_rows(rng, 150, 32)
    if name == "odd":
        rows += [(None, [0.5] * 32, 1), (7, [0.25] * 32, None), (7, [0.25] * 32, None), (200, None, 1), (201, [None] * 32, 1),
                 (202, [float("nan")] * 32, 1), (203, [float("inf")] + [0.0] * 31, 2), (204, [0.0] * 48, 3), (205, [1.0] * 48, 3)]
    if name == "few":
        rows = rows[:5]
    if name == "ties":
        rows = [(i, [float(rng.choice([0, 1])) / 256 for _ in range(32)], 1) for i in range(150)]
    if name == "large":
        rows += random_rows(rng, 20, 32, spread=2.0**20)
        rows = [(i, v, lab) for i, (_, v, lab) in enumerate(rows)]
    if name == "uneven":
        rows = random_rows(rng, 80, 21) + [(100, [], 1), (101, [1.0] * 3, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in codes.report(df).collect()), key=str)
    assert got == by_hand(rows)


def test_empty_and_extra_columns(spark):
    assert codes.report(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, [1.0] * 16, "x", "mine")], "vec_id long, embedding array<float>, label string, code string")
    row = codes.report(df).first()
    assert (row["code"], row["error"], row["label_error"]) == ("00" * 16, 0, 0)


def test_components_beyond_longs_are_an_error(spark):
    df = spark.createDataFrame([(1, [3e38] * 16, 1)], SCHEMA)
    with pytest.raises(Exception, match="fits no long"):
        codes.report(df).collect()


def test_tree_finds_the_nearest_and_spares_distances(rng):
    for _ in range(30):
        width = rng.choice([1, 4, 7])
        book = np.array([[rng.randint(-40, 40) for _ in range(width)] for _ in range(rng.choice([1, 8, 9, 40, 64]))], np.int64)
        points = np.concatenate((np.array([[rng.randint(-60, 60) for _ in range(width)] for _ in range(300)], np.int64), book))
        search = codes.Search(book)
        entry, distance = search.nearest(points)
        every = ((points[:, None] - book[None]) ** 2).sum(axis=2)
        assert entry.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()
        assert search.distances <= every.size
    book = np.array([[1000 * (i % 8) + i, 0] for i in range(64)], np.int64)
    search = codes.Search(book)
    search.nearest(book)
    assert search.distances < 0.5 * len(book) ** 2


def test_codes_stand_for_their_entries(spark, rng):
    rows = random_rows(rng, 40, 32)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id", "cast(embedding AS array<double>) AS vector", "label")
    books = codes.trained(df)
    back = codes.decoded(codes.coded(df, books), books, 32).orderBy("vec_id").collect()
    for row, (_, vector, _) in zip(back, rows, strict=True):
        whole = np.floor(256 * np.array(vector))
        assert int(((whole - 256 * np.array(row["approximation"])) ** 2).sum()) == row["error"]
