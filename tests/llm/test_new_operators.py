"""Hard negatives, HyperMinHash and the prefix trie against plain versions, on small awkward tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rangeloom.llm import common, hard_negatives, hyper_minhash, prefix_trie, regions
from tests.llm import brute
from tests.llm.test_operators import SCHEMA, make_rows, same

# 11


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 64, 33), (40, 3, 100), (17, 65, 16), (64, 64, 64), (5, 0, 9)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(3)
    a, b = rng.integers(-(2**27), 2**27, (m, k)), rng.integers(-(2**27), 2**27, (k, n))
    for leaf in (2, 16):
        assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()


def test_strassen_wraps_on_the_way_only():
    a = np.full((4, 4), 2**62 - 1)
    b = np.eye(4, dtype=np.int64)
    assert (hard_negatives.strassen(a, b, 2) == a).all()


def vectors():
    rng = random.Random(8)
    rows = []
    for k in range(260):
        v = [rng.gauss(0.2 * (k % 3 == j % 3), 0.2) for j in range(9)]
        rows.append((k, v, k % 3, "x", 5))
    rows += [(300 + k, rows[7][1], 1, "copy", 0) for k in range(60)]  # one vector a third of the time
    rows += [rows[100], rows[100], (400, rows[0][1], 2, None, 0)]
    rows += [(500, None, 1, "", 0), (501, [0.1, None], 1, "", 0), (502, [float("nan")], 1, "", 0), (503, [float("inf")], 1, "", 0),
             (504, [0.5] * 9, None, "", 0), (None, [0.5] * 9, 1, "", 0), (600, [], 1, "", 0), (700, [0.3, 0.4], 0, "", 0)]
    return rows


def mined(rows, positives, negatives, low=30, high=90):
    own = []
    for vec_id, v, label, *_ in rows:
        if None in (vec_id, v, label) or any(x is None or x != x or abs(x) == float("inf") for x in v):
            continue
        own.append((vec_id, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v], label))
    out = []
    for k, (anchor, v, label) in enumerate(own):
        if anchor % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i, other != label) for j, (i, w, other) in enumerate(own) if j != k)
        for s, positive, _ in [x for x in scored if not x[2]][:positives]:
            fit = [x for x in scored if x[2] and low * -s <= 100 * -x[0] <= high * -s]
            out += [(anchor, positive, r, i, -s, -t) for r, (t, i, _) in enumerate(fit[:negatives], 1)]
    return out


NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", block)
    monkeypatch.setattr(hard_negatives, "TILE", (3, 50))
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, row string, anchor int")
    found = hard_negatives.mine(table, F.col("vec_id") % 100 == 0)
    same(found, NAMES, mined(rows, 5, 10))
    few = hard_negatives.mine(table, F.col("vec_id") % 100 == 0, positives=2, negatives=3, low=50, high=80)
    same(few, NAMES, mined(rows, 2, 3, 50, 80))


def test_hard_negatives_of_nothing(spark):
    table = spark.createDataFrame(vectors(), "vec_id bigint, embedding array<float>, label int, a string, b int")
    for rows in (table.limit(0), table.where("vec_id % 100 = 1"), table.where("vec_id = 500")):
        assert hard_negatives.mine(rows, F.col("vec_id") % 100 == 0).collect() == []


def test_hard_negatives_refuse_what_is_not_exact(spark):
    table = spark.createDataFrame([(100, [1e30], 1), (1, [1.0], 1)], "vec_id bigint, embedding array<float>, label int")
    with pytest.raises(PySparkException, match="too large"):
        hard_negatives.mine(table, F.col("vec_id") % 100 == 0)


# 12


def random_sets(rng, n, likeness):
    """Two sets of hashes with about this Jaccard similarity, ``n`` in their union."""
    union = rng.integers(0, 2**64, n, np.uint64)
    shared = round(likeness * n)
    side = rng.random(n - shared) < 0.5
    return [np.unique(np.concatenate([union[:shared], union[shared:][own]])) for own in (side, ~side)]


@pytest.mark.parametrize("n", [5, 9, 30, 200, 3000])
def test_every_link_shares_a_band(n):
    rng = np.random.default_rng(n)
    for _ in range(300):
        a, b = (hyper_minhash.bands(hyper_minhash.sketch(s)) for s in random_sets(rng, n, 0.8 if n > 5 else 0.8))
        assert (a == b).any()


@pytest.mark.parametrize("n", [300, 5000])
@pytest.mark.parametrize("likeness", [0.0, 0.5, 0.8, 1.0])
def test_estimates_are_near_the_truth(n, likeness):
    rng = np.random.default_rng(17)
    pairs = [random_sets(rng, n, likeness) for _ in range(60)]
    a, b = (np.stack([hyper_minhash.sketch(p[i]) for p in pairs]) for i in (0, 1))
    sizes = np.array([np.sqrt(float(len(p[0])) * len(p[1])) for p in pairs])
    found, deviation = hyper_minhash.estimate(a, b, sizes, hyper_minhash.chance_matches())
    assert abs(found.mean() - likeness) < 0.03
    assert (abs(found - likeness) < 6 * deviation).all()


def test_registers_hold_zeros_and_mantissa():
    shift = 65 - hyper_minhash.REGISTERS.bit_length()
    hashes = np.array([(3 << shift) | (0b0001011 << (shift - 7)), (9 << shift) | 1], np.uint64)
    own = hyper_minhash.sketch(hashes)
    assert (own != hyper_minhash.EMPTY).sum() == 2
    assert own[3] >> hyper_minhash.MANTISSA == 3 and own[3] & 0x3FF == 0b0110000000
    assert own[9] >> hyper_minhash.MANTISSA == 53


@pytest.mark.parametrize("block, run", [(256, 256), (5, 3)])
def test_hyper_minhash(spark, monkeypatch, block, run):
    monkeypatch.setattr(regions, "BLOCK", block)
    monkeypatch.setattr(regions, "RUN", run)
    rows = make_rows()
    rng = random.Random(4)
    base = [f"w{k}" for k in range(70)]
    for k in range(60):  # a chain of texts: each links with its neighbours only
        base[rng.randrange(70)] = f"n{k}"
        rows.append((3000 + k, " ".join(base), None, None, 0, 0, 0, "", 0))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = hyper_minhash.near_duplicates(docs)
    expected = [(d, n, c, None if d is None else d == c) for d, n, c in brute.near([r[:2] for r in rows], 2)]
    same(found, found.columns, expected)


def test_hyper_minhash_of_nothing(spark):
    found = hyper_minhash.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"] and found.collect() == []


def test_one_id_with_two_texts(spark):
    texts = ["a b c d e f g h", "q r s t u v w x", "a b c d e f g h"]
    docs = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (2, texts[2]), (5, texts[1])], "doc_id bigint, text string")
    found = hyper_minhash.near_duplicates(docs)
    same(found, ["doc_id", "component_id"], [(1, 1), (1, 1), (2, 1), (5, 1)])


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(0, 400)] + [(1000, k) for k in range(1001, 1500)] + [(7, 7), (2000, 2001), (2001, 2000)]
    random.Random(1).shuffle(links)
    found = common.connected_components(spark.createDataFrame(links, "a bigint, b bigint").repartition(7))
    expected = [(k, 0) for k in range(401)] + [(k, 1000) for k in range(1000, 1500)] + [(2000, 2000), (2001, 2000)]
    same(found, ["node", "component"], expected)


# 13


def talk_rows():
    rng = random.Random(9)
    starts = [[("user", f"hello {i} you"), ("assistant", "yes  of course")] for i in range(4)]
    rows = []
    for c in range(120):
        turns = list(starts[rng.choice([0, 0, 0, 1, 2, 3])])
        for _ in range(rng.randint(0, 4)):
            turns.append((rng.choice(["user", "assistant", None]), rng.choice(["a", "b c", "", None, "d e f"])))
        rows += [(c, t, role, text, 1) for t, (role, text) in enumerate(turns[rng.randint(0, 1):])]
    rows += [(c, t, "user", f"same {t}", 2) for c in range(200, 260) for t in range(6)]  # a third are equal
    rows += [(300, t, "user", "x", 0) for t in range(500)] + [(301, None, "user", "first", 0), (301, -5, None, None, 0)]
    rows += [(None, 1, "user", "nobody", 0)]
    return rows


def plain_trie(talks):
    """All nodes of ``{conv_id: [(role, text)]}``."""
    members = {}
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        words = len(brute.ASCII_WORD.findall(node[-1][1])) if node else 0
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * words
    out = []
    for node, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(talks[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), parent, len(own), len(children.get(node, [])), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def in_order(rows):
    talks = {}
    for c, _, role, text, _ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        talks.setdefault(c, []).append((role or "", text or ""))
    return talks


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame(talk_rows(), "conv_id bigint, turn bigint, role string, text string, seq int").repartition(5)


@pytest.mark.parametrize("container", [20_000, 40, 1])
def test_prefix_trie(talks, container):
    found = prefix_trie.prefix_trie(prefix_trie.turn_sequences(talks), container)
    same(found, TRIE, plain_trie(in_order(talk_rows())))


def test_first_turns_of_another(talks):
    sequences = prefix_trie.turn_sequences(talks)
    conv = F.col("conv_id")
    h = F.crc32(conv.cast("string").cast("binary")) % 4
    found = prefix_trie.prefix_trie(prefix_trie.with_first_turns(sequences, conv - conv % 20, h, 3), 10)
    before = in_order(talk_rows())
    after = {}
    for c, turns in before.items():
        n = zlib.crc32(str(c).encode()) % 4
        after[c] = before.get(c - c % 20, [])[:n] + turns[n:]
    same(found, TRIE, plain_trie(after))


def test_trie_of_nothing(talks):
    for rows in (talks.limit(0), talks.where("conv_id IS NULL")):
        assert prefix_trie.prefix_trie(prefix_trie.turn_sequences(rows)).collect() == []
