import hashlib
import math
import random

import numpy as np
import pytest

import compare
from lakeops.llm import queries, vector_codes
from lakeops.llm.vector_codes import Assigner, build_tree


def slow_codes(rows, parts=8, entries=16, rounds=6):
    """(codes and errors of the kept rows, codebook digest) with Python's whole numbers, one comparison at a time."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], ""
    width = len(kept[0][1]) // parts
    cells = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cells[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for c in cells:
                groups.setdefault(nearest(c[p], book)[1], []).append(c[p])
            books[p] = [[sum(x) // len(groups[e]) for x in zip(*groups[e])] if e in groups else c
                        for e, c in enumerate(book)]
    out, by_label = [], {}
    for (i, _, label), c in zip(kept, cells):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    text = ",".join(str(x) for book in books for c in book for x in c)
    return [(i, code, error, by_label[label]) for i, code, error, label in out], hashlib.sha256(text.encode()).hexdigest()


def check(df, rows):
    want, digest = slow_codes(rows)
    found = df.collect()
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(str(tuple(r)[:4]) for r in found) == sorted(map(str, want))
    assert {r.codebooks_sha256 for r in found} <= {digest}


def test_query_on_the_given_table(spark, tiny):
    connection = compare.connect(tiny)
    query = queries.QUERIES["op11_vector_codes"](spark, tiny)
    assert compare.differences(query, connection, queries.ORACLES["op11_vector_codes"]) == ""
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/embeddings.parquet").select(
        "vec_id", "embedding", "label").collect()]
    check(query, rows)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def test_awkward_rows(spark):
    rng = random.Random(5)
    draw = lambda: [float(np.float32(rng.gauss(0, 1))) for _ in range(16)]
    same, grid = draw(), [[rng.choice([-1.0, 0.0, 1.0]) for _ in range(16)] for _ in range(80)]
    nan, inf = float("nan"), float("inf")
    rows = [(i, draw(), i % 3) for i in range(40, 120)]
    rows += [(i, same, None) for i in range(200, 330)]  # a large group of copies
    rows += [(i + 400, v, 7) for i, v in enumerate(grid)]  # many ties
    rows += [(7, same, 1), (7, same, 1), (7, draw(), 2), (None, draw(), 5), (None, same, 5)]
    rows += [(1, None, 1), (2, [nan] + same[1:], 1), (3, same[:-1] + [inf], 1), (4, same[:-1] + [-inf], None),
             (5, [None] + same[1:], 1)]
    rng.shuffle(rows)
    for parts in (1, 5):
        check(vector_codes.report(frame(spark, rows).repartition(parts)), rows)
    assert vector_codes.report(frame(spark, rows).limit(0)).collect() == []
    few = rows[:3] + [r for r in rows if r[0] in (1, 2)]
    check(vector_codes.report(frame(spark, few)), few)


def test_empty_unequal_and_large_vectors(spark):
    found = vector_codes.report(frame(spark, [(1, [], 1), (2, [], None)])).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in found) == [(1, "00" * 8, 0, 0), (2, "00" * 8, 0, 0)]
    large = [(i, [float(1000 * i * (-1) ** (i + j)) for j in range(8)], 1) for i in range(1, 30)]
    check(vector_codes.report(frame(spark, large)), large)
    for bad in ([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], [(1, [1.0] * 9, 1)], [(1, [1e30] * 8, 1)]):
        with pytest.raises(Exception, match="length|too large"):
            vector_codes.report(frame(spark, bad)).collect()


def test_trees_cover_and_separate():
    points = np.random.default_rng(1).integers(-50, 50, (700, 3))
    points[100:300] = points[100]
    tree = build_tree(points)
    assert sorted(tree.order) == list(range(700))
    for node in range(len(tree.row)):
        mine = points[tree.order[tree.start[node]:tree.end[node]]]
        distances = np.sqrt(((mine - points[tree.row[node]]) ** 2).sum(axis=1))
        assert distances.max() <= tree.radius[node]
        children = np.arange(tree.first[node], tree.last[node])
        if len(children):
            assert tree.start[children[0]] == tree.start[node] and tree.end[children[-1]] == tree.end[node]
            assert (tree.start[children[1:]] == tree.end[children[:-1]]).all()
            own = points[tree.row[children]]
            apart = np.sqrt(((own[:, None] - own) ** 2).sum(axis=2))[np.triu_indices(len(own), 1)]
            assert (apart > tree.radius[node] / 2 * (1 - 1e-6)).all()


def test_subtrees_are_assigned_whole():
    rng = np.random.default_rng(2)
    centres = rng.integers(-10 ** 6, 10 ** 6, (12, 8))
    points = centres[rng.integers(0, 12, 2000)] + rng.integers(-500, 500, (2000, 8))
    one = Assigner(points, build_tree(points), centres)
    entry, squares = one.nearest()
    want = ((points[:, None] - centres) ** 2).sum(axis=2)
    assert (entry == want.argmin(axis=1)).all() and (squares == want.min(axis=1)).all()
    assert one.compared < 300  # of 2,000 points
    counts, sums = one.sums()
    assert (counts == np.bincount(entry, minlength=12)).all()
    assert all((sums[e] == points[entry == e].sum(axis=0)).all() for e in range(12))


def test_decoded_vectors_are_near(spark, tiny):
    vectors = spark.read.parquet(f"{tiny}/embeddings.parquet")
    rows, books = vector_codes.compress(vectors)
    given = {r.vec_id: np.array(r.embedding) for r in vectors.collect()}
    error = sum(((vector_codes.decode(r.code, books) - given[r.key]) ** 2).sum() for r in rows.collect())
    mean = np.mean(list(given.values()), axis=0)
    assert error < 0.8 * sum(((v - mean) ** 2).sum() for v in given.values())
