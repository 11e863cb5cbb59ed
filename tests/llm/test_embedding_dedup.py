import numpy as np
import pytest

from tessera.llm import embedding_dedup as M


def brute(rows):
    sound = [(i, label, np.array(e, float)) for i, label, e in rows if label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    links = {i: set() for i, _, _ in rows}
    for i, a, x in sound:
        for j, b, y in sound:
            if i != j and a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= M.THRESHOLD:
                links[i].add(j)
    root = {i: i for i in links}
    changed = True
    while changed:
        changed = False
        for i in links:
            low = min([root[i], *(root[j] for j in links[i])])
            if low < root[i]:
                root[i], changed = low, True
    return {i: (len(links[i]), root[i], root[i] == i) for i in links}


def run(spark, rows):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in M.near_vectors(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")).collect()}


def cloud(seed, n, spread, dim=16):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((6, dim))
    return [(i, int(i % 2), (centres[r.integers(6)] + spread * r.standard_normal(dim)).astype(np.float32).tolist()) for i in range(n)]


def test_loose_and_tight_groups_equal_brute_force(spark):
    for seed, spread in ((1, 0.05), (2, 0.25)):
        rows = cloud(seed, 300, spread)
        assert run(spark, rows) == brute(rows)


def test_awkward_vectors(spark):
    rows = [(1, 0, [1.0, 0.0]), (2, 0, [2.0, 0.0]), (3, 1, [1.0, 0.0]), (4, None, [1.0, 0.0]), (5, 0, None), (6, 0, [0.0, 0.0]), (7, 0, [float("nan"), 1.0]), (8, 0, [float("inf"), 1.0]), (9, 0, [None, 1.0]), (10, 0, []), (11, 0, [1.0]), (12, 0, [1e-30, 0.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [rows[0], rows[0]]) == {1: (0, 1, True)}
    assert run(spark, []) == {}


def test_cell_passes_follow_the_size():
    assert M.cells_for(2 * M.CELL - 1) == (0, 1) and 2 <= M.cells_for(20_000)[1] < M.cells_for(10**9)[1] < 200


def test_double_vectors_and_repeated_ids(spark):
    x = [1.0, 1e-9]
    rows = [(1, 0, x), (2, 0, [1.0, 0.0]), (2, 0, [0.0, 1.0]), (3, 0, [1e-12, 1.0]), (None, 0, x)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for n in (1, 5):  # of vector 2 the row of least components counts
        got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in M.near_vectors(frame.repartition(n)).collect())
        assert got == [(0, 0, None, True), (1, 0, 1, True), (2, 1, 2, True), (2, 1, 2, True), (3, 1, 2, False)]


@pytest.mark.parametrize("cell", [M.CELL, 1024])
def test_clusters_around_a_common_direction_equal_brute_force(spark, monkeypatch, cell):
    """Vectors at a common cosine of 0.85, some with a partner at 0.935; one cell, and many."""
    monkeypatch.setattr(M, "CELL", cell)
    r = np.random.default_rng(12)
    n, dim, rho = 8000, 64, 0.85
    centre = np.zeros(dim)
    centre[0] = 1
    x = np.sqrt(rho) * centre + np.sqrt((1 - rho) / (dim - 1)) * np.c_[np.zeros((n, 1)), r.standard_normal((n, dim - 1))]
    x /= np.sqrt((x * x).sum(1))[:, None]
    y = r.standard_normal((n // 4, dim))
    y -= (y * x[: n // 4]).sum(1)[:, None] * x[: n // 4]
    y /= np.sqrt((y * y).sum(1))[:, None]
    x[n // 4 : n // 2] = 0.935 * x[: n // 4] + np.sqrt(1 - 0.935**2) * y
    rows = [(i, 0, e) for i, e in enumerate(x.astype(np.float32).tolist())]
    assert run(spark, rows) == brute_components(x, list(range(n)))


def brute_components(x, ids):
    """The least id that each vector reaches, and its links, of one label."""
    x = x.astype(np.float32).astype(float)
    x /= np.sqrt((x * x).sum(1))[:, None]
    close = x @ x.T >= M.THRESHOLD
    np.fill_diagonal(close, False)
    left, right = np.nonzero(close)
    root = M.local_roots(len(x), left, right)
    return {ids[i]: (int(close[i].sum()), ids[root[i]], root[i] == i) for i in range(len(x))}


def test_dense_cloud_of_thousands_equals_brute_force(spark):
    r = np.random.default_rng(6)
    centre = r.standard_normal(64)
    x = centre / np.sqrt(centre @ centre) * 8 + 0.40 * r.standard_normal((3000, 64))
    expected = brute_components(x, list(range(3000)))
    assert 500 < sum(n > 0 for n, _, _ in expected.values()) < 2900
    assert run(spark, [(i, 0, e) for i, e in enumerate(x.astype(np.float32).tolist())]) == expected


def test_pairs_across_range_partitions_are_met(spark):
    r = np.random.default_rng(8)
    a = r.standard_normal((40, 64))
    a /= np.sqrt((a * a).sum(1))[:, None]
    b = r.standard_normal((40, 64))
    b -= (a * b).sum(1)[:, None] * a
    b /= np.sqrt((b * b).sum(1))[:, None]
    x = np.concatenate([a, 0.935 * a + np.sqrt(1 - 0.935**2) * b])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert run(spark, [(i, 0, e) for i, e in enumerate(x.astype(np.float32).tolist())]) == brute_components(x, list(range(80)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_windows_alone_unite_planted_copies(spark):
    """Groups of 2 to 40 copies at cosines of 0.94 to 0.99 to their original, in labels of some hundred vectors: no cell pass is needed for them."""
    from pyspark.sql import functions as F

    r = np.random.default_rng(21)
    rows, want, at = [], {}, 0
    for label in range(6):
        vectors = []
        for size in (2, 2, 3, 5, 12, 40, *[1] * 150):
            base = r.standard_normal(64)
            base /= np.sqrt(base @ base)
            vectors.append(base)
            for _ in range(size - 1):
                noise = r.standard_normal(64)
                noise -= (noise @ base) * base
                c = r.uniform(0.94, 0.99)
                vectors.append(c * base + np.sqrt(1 - c * c) * noise / np.sqrt(noise @ noise))
        x = np.array(vectors)
        want |= {at + i: at + found[1] for i, found in brute_components(x, list(range(len(x)))).items() if found[0]}
        rows += [(at + i, label, e) for i, e in enumerate(x.astype(np.float32).tolist())]
        at += len(x)
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(4)
    kind = M.stored_kind(frame)
    order = ["pass", "label", "key", F.xxhash64("vec_id")]
    ranged = M.keyed(M.sound_vectors(frame), M.PASSES, kind).repartitionByRange(4, *order).sortWithinPartitions(*order)
    got = {x.vertex: x.component for x in M.components(M.neighbour_links(ranged, kind, M.THRESHOLD)).collect()}
    assert len(want) > 300 and sum(got.get(i) == c for i, c in want.items()) >= 0.99 * len(want)
    assert all(c == want[i] or c > want[i] for i, c in got.items() if i in want)
