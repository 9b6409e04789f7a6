import numpy as np

from lakeops.llm.embed_dedup import near_duplicates, tile_links, unit_rows

from .helpers import same_as_oracle


def brute(rows, threshold=0.98):
    fine = {k: np.array(v, float) for k, (_, v, lab) in enumerate(rows) if v and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {k: set() for k in range(len(rows))}
    for a in fine:
        for b in fine:
            if a != b and rows[a][2] == rows[b][2] and len(fine[a]) == len(fine[b]) and fine[a] @ fine[b] / np.sqrt(fine[a] @ fine[a]) / np.sqrt(fine[b] @ fine[b]) >= threshold:
                links[a].add(b)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            todo += [x for x in links[todo.pop()] - seen if not seen.add(x)]
        ids = [rows[x][0] for x in seen if rows[x][0] is not None]
        least = min(ids) if ids else None
        out.append((i, len(links[k]), least, i is not None and i == least))
    return sorted(out, key=str)


def check(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 5, 6, 7) for r in rows], "vec_id long, embedding array<float>, label int, node int, many int, root int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_duplicates(df, **kw).collect()), key=str)
    assert got == brute(rows)


def test_against_brute_force_in_many_blocks(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    rows = [(int(i), [float(np.float32(x)) for x in centres[i % 12] + rng.normal(scale=0.12, size=8)], int(i % 3)) for i in range(300)]
    check(spark, rows, block=40)


def test_awkward_rows(spark):
    v = [1.0, 2.0, 3.0]
    check(spark, [(1, v, 1), (1, v, 1), (2, [2.0, 4.0, 6.0], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 2.0], 1),
                  (9, [float("nan"), 1.0, 1.0], 1), (10, [float("inf"), 1.0, 1.0], 1), (None, v, 1), (11, [1.0, 2.0], 1), (None, [5.0, 1.0], 9), (12, [1e38, 2e38, 3e38], 1)])


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert near_duplicates(df).collect() == []


def test_bounds_never_lose_a_pair():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 16))
    u = unit_rows(np.r_[base, base + rng.normal(scale=0.2, size=base.shape)])
    for threshold in (0.5, 0.9, 0.98, float(np.sort((u @ u.T).ravel())[-500])):
        exact = np.array([[(a * b).sum() for b in u] for a in u]) >= threshold
        assert (tile_links(u, u, threshold) == exact).all()


def test_oracle(spark):
    same_as_oracle(spark, "op2_embedding_dedup")
