import math
import random

import pyarrow as pa
import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankflow.functions import blocks
from rankflow.operators import levels, neighbours, similarity
from rankflow.sources.schemas import SIMILARITY, USER_POST_SCORES


def brute_force(triples):
    """Cosine of every pair of users with a common post, in plain Python."""
    vectors = {}
    for user, post, score in triples:
        vectors.setdefault(user, {})[post] = score
    norms = {u: sum(s * s for s in v.values()) for u, v in vectors.items()}
    found = {}
    for a in vectors:
        for b in vectors:
            shared = vectors[a].keys() & vectors[b].keys()
            if a < b and shared and norms[a] and norms[b]:
                dot = sum(vectors[a][p] * vectors[b][p] for p in shared)
                found[a, b] = dot / (math.sqrt(norms[a]) * math.sqrt(norms[b]))
    return found


def brute_neighbours(triples, k):
    lists = {}
    for (a, b), value in brute_force(triples).items():
        lists.setdefault(a, []).append((-value, b))
        lists.setdefault(b, []).append((-value, a))
    return sorted(
        ((u, v, -value) for u, near in lists.items() for value, v in sorted(near)[:k]), key=repr
    )


def random_triples(seed, users, posts, density, top_score=3, popular=0):
    """Scores with zeros; the first ``popular`` posts are touched by nearly all users."""
    draw = random.Random(seed)
    return [
        (u, p, draw.randint(0, top_score))
        for u in range(users)
        for p in range(posts)
        if draw.random() < (0.9 if p < popular else density)
    ]


def similar(scores, heavy_post_users=1000):
    return similarity.user_similarity(similarity.pair_dot_products(scores, heavy_post_users))


def test_cosine_by_hand(table):
    scores = table([(1, 101, 3), (1, 102, 4), (2, 101, 4), (2, 102, 3)], USER_POST_SCORES)
    assert rows(similar(scores)) == [(1, 2, 0.96)]
    assert rows(similarity.user_magnitudes(scores)) == [(1, 5.0), (2, 5.0)]
    pairs = similarity.pair_dot_products(scores, 1000)
    assert rows(pairs, "dot_product", "shared_posts") == [(24, 2)]


def test_no_common_post_no_row(table):
    assert rows(similar(table([(1, 101, 1), (2, 102, 1)], USER_POST_SCORES))) == []


def test_a_user_without_weight_has_no_similarity(table):
    scores = table([(1, 1, 0), (2, 1, 2), (3, 1, 2)], USER_POST_SCORES)
    assert rows(similar(scores)) == [(2, 3, 1.0)]
    for limit in (1, 1000):
        near = neighbours.nearest_users_any(scores, 10, heavy_post_users=limit)
        assert rows(near) == [(2, 3, 1.0), (3, 2, 1.0)]


def test_zero_cosines_are_neighbours(table):
    triples = [(1, 1, 0), (1, 2, 5), (2, 1, 3), (3, 1, 0), (3, 3, 2)]
    scores = table(triples, USER_POST_SCORES)
    for limit in (1, 1000):
        near = neighbours.nearest_users_any(scores, 10, heavy_post_users=limit)
        assert rows(near) == brute_neighbours(triples, 10)
        assert len(rows(near)) == 6


def test_edges_point_both_ways(table):
    edges = similarity.bidirectional(table([(1, 2, 0.5), (1, 3, 0.25)], SIMILARITY))
    assert rows(edges) == [(1, 2, 0.5), (1, 3, 0.25), (2, 1, 0.5), (3, 1, 0.25)]


def test_equal_neighbours_go_by_id(table):
    edges = table([(0, b, 0.5) for b in range(1, 15)], SIMILARITY)
    top = neighbours.top_similar_users(edges, 10).where("user_id = 0")
    assert [r[1] for r in rows(top)] == sorted(range(1, 11), key=lambda i: repr((0, i, 0.5)))


@pytest.mark.parametrize("tile", [1, 3, 1000])
def test_tiles_do_not_change_the_pairs(table, tile):
    triples = random_triples(1, 25, 12, 0.4, popular=2)
    scores = table(triples, USER_POST_SCORES)
    expected = sorted(((a, b, v) for (a, b), v in brute_force(triples).items()), key=repr)
    assert rows(similar(scores, tile)) == expected


@pytest.mark.parametrize("limit", [1, 4, 10, 1000])
@pytest.mark.parametrize("block", [4, 2048])
def test_neighbours_match_brute_force(table, limit, block):
    triples = random_triples(2, 60, 25, 0.12, popular=2)
    near = neighbours.nearest_users_any(
        table(triples, USER_POST_SCORES), 3, heavy_post_users=limit, block_users=block
    )
    assert rows(near) == brute_neighbours(triples, 3)


@pytest.mark.parametrize("limit", [5, 1000])
def test_many_users_with_one_vector(table, limit):
    """A hot post, most of whose users did nothing else."""
    draw = random.Random(3)
    triples = [(u, 0, draw.choice([0, 1, 1, 1, 3])) for u in range(150)]
    triples += [(u, draw.randint(1, 40), draw.randint(0, 5)) for u in range(0, 150, 4)]
    near = neighbours.nearest_users_any(
        table(triples, USER_POST_SCORES), 4, heavy_post_users=limit, block_users=16
    )
    assert rows(near) == brute_neighbours(triples, 4)


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(
    triples=st.dictionaries(
        st.tuples(st.integers(0, 9), st.integers(0, 5)), st.integers(-3, 4), max_size=40
    ),
    limit=st.integers(1, 6),
    k=st.integers(1, 4),
)
def test_any_matrix_any_limit(table, triples, limit, k):
    triples = [(u, p, s) for (u, p), s in triples.items()]
    near = neighbours.nearest_users_any(
        table(triples, USER_POST_SCORES), k, heavy_post_users=limit, block_users=3
    )
    assert rows(near) == brute_neighbours(triples, k)


SIGNED = [(1, 0, 5), (1, 1, 5), (1, 2, 1), (2, 0, 5), (2, 1, -5), (3, 2, 1), (3, 3, 3)]


@pytest.mark.parametrize("limit", [1, 2, 20, 500])
@pytest.mark.parametrize("k", [1, 2, 5])
def test_signed_scores_at_any_limit(table, limit, k):
    draw = random.Random(11)
    dense = [(u, p, draw.randint(-4, 4)) for u in range(30) for p in draw.sample(range(12), 6)]
    for triples in (SIGNED, dense):
        near = neighbours.nearest_users_any(
            table(triples, USER_POST_SCORES), k, heavy_post_users=limit, block_users=8
        )
        assert rows(near) == brute_neighbours(triples, k)


@pytest.mark.parametrize("limit", [1, 3, 500])
@pytest.mark.parametrize("low", [0, -3])
def test_fractional_scores_at_any_limit(table, limit, low):
    draw = random.Random(12)
    triples = [
        (u, p, draw.uniform(low, 3)) for u in range(25) for p in draw.sample(range(15), 5)
    ]
    schema = "user_id bigint, post_id bigint, total_score double"
    near = rows(neighbours.nearest_users_any(table(triples, schema), 3, heavy_post_users=limit))
    expected = brute_neighbours(triples, 3)
    assert [r[:2] for r in near] == [r[:2] for r in expected]
    assert [r[2] for r in near] == pytest.approx([r[2] for r in expected])


def test_products_of_given_pairs_only(table):
    triples = random_triples(9, 20, 10, 0.4)
    edges = table([(1, 2), (3, 4), (3, 4), (5, 19), (0, 99)], "user_a bigint, user_b bigint")
    got = similarity.edge_products(edges, table(triples, USER_POST_SCORES))
    every = brute_force(triples)
    assert rows(got, "user_a", "user_b", "cosine_similarity") == sorted(
        ((a, b, every[a, b]) for a, b in [(1, 2), (3, 4), (5, 19)] if (a, b) in every), key=repr
    )


def test_order_and_partitioning_of_input_change_nothing(table):
    triples = random_triples(5, 40, 15, 0.3)
    shuffled = triples[:]
    random.Random(6).shuffle(shuffled)
    near = [
        rows(neighbours.nearest_users_any(df, 5, heavy_post_users=12))
        for df in (
            table(triples, USER_POST_SCORES),
            table(shuffled, USER_POST_SCORES).repartition(7),
        )
    ]
    assert near[0] == near[1]


def test_most_similar_pairs_come_from_the_lists(table):
    triples = random_triples(7, 40, 12, 0.4)
    near = neighbours.nearest_users_any(
        table(triples, USER_POST_SCORES), 6, heavy_post_users=1000
    )
    best = sorted((-v, a, b) for (a, b), v in brute_force(triples).items())[:6]
    got = [tuple(r) for r in similarity.most_similar_pairs(near, 6).collect()]
    assert got == [(a, b, -v) for v, a, b in best]


@pytest.mark.parametrize("products", [1, 50, 400, 10**6])
@pytest.mark.parametrize("limit", [6, 1000])
def test_cells_of_any_size_give_the_same_neighbours(table, products, limit):
    """One user has touched everything, so small cells compare it part by part."""
    triples = random_triples(13, 50, 20, 0.15, popular=1) + [(99, p, 1 + p % 3) for p in range(20)]
    near = neighbours.nearest_users_any(
        table(triples, USER_POST_SCORES), 4, heavy_post_users=limit, cell_products=products
    )
    assert rows(near) == brute_neighbours(triples, 4)


def test_a_cell_holds_a_bounded_number_of_products(table):
    triples = random_triples(14, 400, 100, 0.08) + [(999, p, 2) for p in range(100)]
    scores = similarity.with_norms(table(triples, USER_POST_SCORES)).withColumn("has_vector", F.lit(False))
    index = neighbours._index(scores)
    cells = neighbours._cells(index, 4_000)
    each = cells.groupBy("cell", "part").agg(F.sum(F.size("asks") * F.size("others")).alias("n"))
    sizes = [r.n for r in each.collect()]
    assert sum(sizes) == sum(r.n_users**2 for r in index.collect())
    assert len(sizes) > 20 and max(sizes) < 4 * 4_000


def test_products_are_shuffled_in_a_few_bytes_each(table):
    draw = random.Random(15)
    triples = [(u, p, draw.randint(1, 5)) for p in range(60) for u in draw.sample(range(3000), 300)]
    scores = similarity.with_norms(table(triples, USER_POST_SCORES)).withColumn("has_vector", F.lit(False))
    index = neighbours._index(scores).coalesce(1).cache()
    cells = neighbours.packed_cells(index, 1_000_000)
    entries = neighbours._cells(index, 1_000_000).agg(F.sum(F.size("others"))).first()[0]
    assert cells.agg(F.sum(F.length("posts"))).first()[0] < 8 * entries


@pytest.mark.parametrize("top", [2**7 - 1, 2**15, 2**40, 2**63 - 1])
def test_blocks_of_a_cell_give_back_what_was_dealt(top):
    """Ids far apart and near, of any sign, and scores that are whole or fractional."""
    ids = [-(2**63), -5, 0, 3, 2**40, 2**63 - 1]
    found = [
        [{"user_id": u, "total_score": s, "norm2": n, "n_posts": 1, "has_vector": u < 0} for u, s, n in post]
        for post in ([(u, top, 7) for u in ids], [(3, -top, 1), (4, 0, top)], [(9, 1, 2)])
    ]
    for kind in (pa.int64(), pa.float64()):
        entry = pa.struct([("user_id", pa.int64()), ("total_score", kind), ("norm2", pa.int64()), ("n_posts", pa.int64()), ("has_vector", pa.bool_())])
        whole = [[e | {"total_score": float(e["total_score"]) / 3} if kind == pa.float64() else e for e in post] for post in found]
        lists = pa.array(whole, pa.list_(entry))
        batch = pa.record_batch([lists, pa.array([3] * 3), pa.array([6] * 3)], ["found", "n_cells", "largest"])
        [packed] = blocks.deal_posts(1000)(iter([batch]))
        [listed] = blocks.deal_posts(1000, packed=False)(iter([batch]))
        assert sorted(set(listed["cell"].to_pylist())) == packed["cell"].to_pylist()
        for row in packed.to_pylist():
            sides = blocks._cell_entries(pa.table({"posts": [row["posts"]]}))
            of_cell = [r for r in listed.to_pylist() if r["cell"] == row["cell"]]
            for side, entries in zip(("asks", "others"), sides, strict=True):
                assert entries.pop("lengths").tolist() == [len(r[side]) for r in of_cell]
                expected = [e for r in of_cell for e in r[side]]
                assert {n: v.tolist() for n, v in entries.items()} == {n: [e[n] for e in expected] for n in entries}


def test_numbers_of_a_cell_take_few_bytes():
    """A product takes the step from the id before, a small score and a small norm."""
    draw = random.Random(5)
    norms = [draw.randint(100, 900) for _ in range(60_000)]
    found = [
        [
            {"user_id": u, "total_score": draw.randint(1, 9), "norm2": norms[u], "n_posts": 1, "has_vector": False}
            for u in draw.sample(range(60_000), 30)
        ]
        for _ in range(400)
    ]
    batch = pa.record_batch([pa.array(found), pa.array([20] * 400), pa.array([30] * 400)], ["found", "n_cells", "largest"])
    size = sum(len(row.as_py()) for dealt in blocks.deal_posts(10**6)(iter([batch])) for row in dealt["posts"])
    assert size < 2.2 * 400 * 30 * 30


@pytest.mark.parametrize("bits", [3, 22])
@pytest.mark.parametrize("low", [0, -3])
def test_edges_below_a_floor_are_not_ranked(table, monkeypatch, bits, low):
    """floors from the scores leave the lists as they are, whatever users share a cell, and signed scores have none."""
    monkeypatch.setattr(levels, "LEVEL_BITS", bits)
    draw = random.Random(bits)
    triples = [(u, p, draw.randint(low, 5)) for u in range(80) for p in range(30) if draw.random() < 0.2]
    scores = table([*triples, (90, None, 5), (91, None, 5), (92, None, 5)], USER_POST_SCORES)
    edges = similar(scores)
    floors = neighbours.least_cosines(scores, 2)
    near = neighbours.top_similar_users(edges, 2, floors)
    assert rows(near) == rows(neighbours.top_similar_users(edges, 2)) == brute_neighbours(triples, 2)
    assert (floors.where("floor > 0").count() > 40) == (low == 0)
    below = similarity.bidirectional(edges).join(floors, "user_id").where("cosine_similarity < floor").count()
    assert low < 0 or below > 0
    text = plan(near)
    assert text.rindex("WindowGroupLimit") > text.index("Exchange") > text.index("WindowGroupLimit")
