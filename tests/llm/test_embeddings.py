import numpy as np
from pyspark.sql import functions as F

from quarry.llm import polytope

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, copies long, codes string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], c, 1, 2, "z")
                                  for i, v, c in rows], SCHEMA).repartition(3)


def brute(rows):
    ok = [v is not None and len(v) and c is not None and i is not None and all(x is not None and np.isfinite(x) for x in v)
          and any(v) for i, v, c in rows]
    unit = [np.array(v, np.float32).astype(float) if k else None for (_, v, _), k in zip(rows, ok, strict=True)]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    near = [[y for y in range(len(rows)) if y != x and ok[x] and ok[y] and rows[x][2] == rows[y][2] and len(unit[x]) == len(unit[y])
             and unit[x] @ unit[y] >= 0.93] for x in range(len(rows))]
    out = []
    for x, (i, _, _) in enumerate(rows):
        seen, todo = {x}, [x]
        while todo:
            y = todo.pop()
            same = [z for z, r in enumerate(rows) if ok[z] and ok[y] and r[0] == rows[y][0]]
            for z in [*near[y], *same]:
                if z not in seen:
                    seen.add(z)
                    todo.append(z)
        low = None if i is None else min(rows[y][0] for y in seen)
        out.append((str(i), len(near[x]), str(low), i is None or low == i))
    return sorted(out)


def got(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in df.collect())


def around(rng, center, cosine):
    z = rng.normal(size=len(center))
    z -= z @ center * center
    return cosine * center + np.sqrt(1 - cosine ** 2) * z / np.linalg.norm(z)


def cases():
    rng, rows = np.random.default_rng(2), []
    for k in range(12):
        c = rng.normal(size=64)
        c /= np.linalg.norm(c)
        rows += [(len(rows) + j, around(rng, c, s).tolist(), k % 3) for j, s in enumerate([1, 0.99, 0.97, 0.95, 0.94, 0.92, 0.8])]
        chain = c
        for _ in range(5):
            chain = around(rng, chain, 0.945)
            rows.append((len(rows), chain.tolist(), k % 3))
    hub = rng.normal(size=64)
    hub /= np.linalg.norm(hub)
    rows += [(2000 + j, around(rng, hub, 0.975).tolist(), 1) for j in range(150)]
    rows += [(3000 + j, hub.tolist(), 1) for j in range(20)]
    rows += [(4000, [0.0] * 64, 1), (4001, None, 1), (4002, [None] + [1.0] * 63, 1), (4003, [float("nan")] * 64, 1), (4004, [], 1),
             (4005, [float("inf")] + [1.0] * 63, 1), (4006, hub.tolist(), None), (None, hub.tolist(), 1), (4007, [1.0, 2.0], 1),
             (4008, [2.0, 4.0], 1), (4009, (hub * 1e30).tolist(), 1), (4010, (hub * 1e-30).tolist(), 1), (5, hub.tolist(), 1)]
    return rows


def test_equals_all_pairs(spark):
    rows = cases()
    assert got(polytope.near_vectors(table(spark, rows))) == brute(rows)


def test_blocks_of_a_large_bucket(spark):
    rows = cases()
    assert got(polytope.near_vectors(table(spark, rows), block=16)) == brute(rows)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = np.stack([around(rng, x, 0.93) for x in a])
    hit = np.zeros(len(a), bool)
    for t in range(polytope.TABLES):
        x, y = polytope.buckets(a, t), polytope.buckets(b, t)
        hit |= (x == y[:, :1]).any(axis=1) | (y == x[:, :1]).any(axis=1)
    assert hit.mean() > 0.9995


def test_empty_table(spark):
    assert polytope.near_vectors(table(spark, [])).count() == 0
    assert polytope.near_vectors(table(spark, cases()[:3]).where(F.lit(False))).count() == 0
