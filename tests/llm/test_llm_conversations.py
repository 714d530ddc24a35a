"""Operators on conversations and hard negatives, each against a plain version in Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.llm import chat, hard_negatives, prefix_trie

CONVERSATION = "conv_id long, turn long, role string, text string, item string, path string, conv string, block string"


@pytest.fixture(scope="module")
def said(session):
    def conversations(rows):
        return session.createDataFrame([(*r, *("x",) * 4) for r in rows], CONVERSATION)

    return conversations


def odd_conversations(rng):
    """Shared beginnings, copies, missing bases, null fields, ties, repeated rows, one long conversation."""
    texts = ["", None, "a", "ä🙂", "bb", "</s>", r"<\s>", r"[\\INST] \ <image:1>", "<", "[INST", "c\nd"]
    rows = []
    for conv in [*range(-7, 40), 1000, 1003]:
        if conv in (10, 20):  # the base of others
            continue
        for turn in range(rng.randrange(1, 12)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", None, "od\nd</s>"]), rng.choice(texts)))
    rows += [(50 + i, t, "user", f"same {t}") for i in range(60) for t in range(4)]
    rows += [(200, t, "assistant", f"t{t % 3}") for t in range(3000)] + [(201, t, "assistant", f"t{t % 3}") for t in range(2900)]
    rows += [(300, None, "user", "z"), (300, 5, "user", "b"), (300, 5, "user", "b"), (None, 1, "user", "lost")]
    rows.append((302, 0, "user", "x" * 200_000))
    return rows


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - (abs(conv) % 5 if conv >= 0 else -(abs(conv) % 5))
        out[conv] = own.get(base, [])[:h] + turns[h:]
    return out


def trie(paths):
    """Every node by its definition."""
    members, keys = defaultdict(list), {(): 0}
    for conv, turns in paths.items():
        node = 0
        members[node].append((conv, not turns))
        for depth, turn in enumerate(turns, 1):
            node = keys.setdefault((node, *turn), len(keys))
            members[node].append((conv, depth == len(turns)))
    parent = {n: k[0] for k, n in keys.items() if k}
    text = {n: k[2] for k, n in keys.items() if k}
    children = Counter(parent.values())
    leaves, saved, depth = Counter(), Counter(), {0: 0}
    for node in members:  # parents have smaller numbers
        if node:
            depth[node] = depth[parent[node]] + 1
    for node in sorted(members, reverse=True):
        leaves[node] += not children[node]
        if node:
            saved[node] += (len(members[node]) - 1) * len(text[node].encode())
            leaves[parent[node]] += leaves[node]
            saved[parent[node]] += saved[node]
    least = {n: min(c for c, _ in m) for n, m in members.items()}
    return Counter((
        least[n], depth[n], least[parent[n]] if n else None, len(m), children[n], leaves[n], saved[n],
        hashlib.sha256(",".join(map(str, sorted(c for c, end in m if end))).encode()).hexdigest(),
    ) for n, m in members.items())


def found_nodes(df, **settings):
    conv = F.col("conv")
    taken = F.crc32(conv.cast("string").cast("binary")) % 9
    paths = prefix_trie.rebuilt(prefix_trie.items(df, "conv_id", "turn", "role", "text"), conv - conv % 5, taken, 8)
    return Counter(tuple(r) for r in prefix_trie.nodes(paths, **settings).select(prefix_trie.RESULT).collect())


@pytest.mark.parametrize("settings", [{}, {"shard_bytes": 300, "bits": 2, "least_shards": 5}])
def test_prefix_trie(said, settings):
    rows = odd_conversations(random.Random(4))
    # Conversation 405 has no turn left after its first h, and no base.
    lost = next(c for c in range(401, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows += [(lost, 0, "user", "a"), (lost, 1, "user", "b")]
    paths = rebuilt(rows)
    assert paths[lost] == []
    assert found_nodes(said(rows), **settings) == trie(paths)


def test_prefix_trie_without_rows(said):
    assert not found_nodes(said([])) and not found_nodes(said([(None, 1, "user", "a")]))
    assert sum(found_nodes(said([(5, 0, None, None)])).values()) == 2


def test_splitters_and_skeleton():
    item = lambda n: bytes([n]) * 16 + (7).to_bytes(4, "big")
    paths = [b"".join(map(item, p)) for p in ([1], [1, 2, 3], [1, 2, 4], [2, 9], [2, 9, 9], [3])]
    cut = prefix_trie.separators(paths, 6)
    assert cut == [p[:n * 20] for p, n in zip(paths[1:], (2, 3, 1, 3, 1), strict=True)]
    made = prefix_trie.Skeleton.of(cut)
    assert [made.shard(p) for p in paths] == [0, 1, 2, 3, 4, 5]
    assert len(made.parent) == len({c[:n] for c in cut for n in range(0, len(c) + 1, 20)})
    assert len(made.along(1, paths[1])) == 3 and len(made.along(0, paths[0])) == 2
    assert prefix_trie.separators(paths, 6, most=60) == cut[1::2][1::2]


def test_chat_round_trip_of_texts(said):
    rows = odd_conversations(random.Random(5))
    turns = said(rows).withColumn("parts", chat.text_part(F.col("text")))
    made = chat.read_back(chat.formatted(turns, "conv_id", "turn", "role", "parts"))
    expected = defaultdict(list)
    for conv, turn, role, text in rows:
        expected[conv].append((turn is not None, turn or 0, role or "", text or ""))
    body = lambda c: [("".join(t.texts), t.role) for t in c.said]
    got = made.collect()
    assert len(got) == len(expected)
    for c in got:
        own = sorted(expected[c.conv], key=lambda t: t[:3])
        assert sorted(body(c)) == sorted((t, r) for *_, r, t in own)
        assert [t.role for t in c.said] == [r for *_, r, _ in own]
        for t, place in zip(c.said, c.turns, strict=True):
            assert t.learnt == ("".join(t.texts) if t.role == "assistant" else None)
            assert c.formatted[place.at :].startswith("<s>") and c.formatted[place.stop :].startswith("[/INST]</s>")
        assert c.formatted.count("</s>") == len(own) and c.formatted.count("[INST]") == len(own)
    digests = {r.conv_id: r for r in chat.digests(made).collect()}
    for conv, own in expected.items():
        whole = [(r, t) for *_, r, t in sorted(own)]
        if len({(t[:3]) for t in own}) == len(own):  # ties in turn and role are ordered by their escaped body
            joined = "".join(f"{r}\n{t}\n" for r, t in whole)
            assert digests[conv].turns_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        learnt = "".join(t for r, t in whole if r == "assistant")
        assert digests[conv].loss_chars == len(learnt) and digests[conv].n_turns == len(own)
    empty = chat.formatted(said([]).withColumn("parts", chat.text_part(F.col("text"))), "conv_id", "turn", "role", "parts")
    assert chat.digests(chat.read_back(empty)).count() == 0


def test_chat_parts(session):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    first = [part("text", "look <image:1> <"), part("text", "s> at"), part("image", None, "a.png", 57, 28),
             part("audio", "no", "b.wav", None, None, 1.01), part("text", ""), part("document", None, "c.pdf", p=3)]
    second = [part("image", ref="d.png"), None, part("video", "as text"), part(None, "[INST]")]
    rows = [(1, 0, "user", first), (1, 1, "assistant", second), (1, 2, "user", None), (2, 0, "assistant", [])]
    made = chat.formatted(session.createDataFrame(
        rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>"), "conv_id", "turn", "role", "parts")
    got = {c.conv: c for c in chat.read_back(made).collect()}
    one = got[1]
    assert one.formatted.startswith(
        r"<s>user[INST]look <\image:1> <<+>s> at<image:2><audio:3><document:5>[/INST]</s><s>assistant[INST]<image:0>")
    assert [tuple(a) for a in one.attachments] == [
        (0, 2, "image", "a.png", 3), (0, 3, "audio", "b.wav", 26), (0, 5, "document", "c.pdf", 1536),
        (1, 0, "image", "d.png", 1)]
    assert one.expanded == 3 + 26 + 1536 + 1
    # Between placeholders, texts come back as they were; an empty one stands where nothing was.
    assert one.said[0].texts == ["look <image:1> <", "s> at", "", "", ""]
    assert one.said[1].texts == ["", "", "as text", "[INST]"] and one.said[1].learnt == "as text[INST]"
    assert one.said[2].texts == [""] and got[2].said[0].learnt == ""


VECTOR = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), *(T.StructField(c, T.StringType()) for c in ("id", "block", "score"))])


def mined(rows, dimensions):
    """Anchors, positives and negatives by the plain definition."""
    fine = {(i, tuple(v), lab) for i, v, lab in rows if i is not None and lab is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v)}
    ids = np.array([r[0] for r in fine])
    vectors = np.zeros((len(fine), dimensions), np.int64)
    for at, (_, v, _) in enumerate(fine):
        vectors[at, : len(v)] = np.floor(np.array(v, np.float32).astype(float) * 256)
    labels = np.array([r[2] for r in fine])
    out = Counter()
    for a in np.flatnonzero(ids % 100 == 0):
        score = vectors @ vectors[a]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[a]]
        for p in [j for j in order if labels[j] == labels[a]][:5]:
            fits = [j for j in order if labels[j] != labels[a] and 30 * score[p] <= 100 * score[j] <= 90 * score[p]][:10]
            for rank, j in enumerate(fits, 1):
                out[(ids[a], ids[p], rank, ids[j], score[p], score[j])] += 1
    return out


def found_negatives(session, rows, **settings):
    df = session.createDataFrame([(*r, *("x",) * 3) for r in rows], VECTOR)
    got = hard_negatives.mine(df, "vec_id", F.col("label"), "embedding", "id % 100 = 0", **settings).collect()
    return Counter((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got)


@pytest.mark.parametrize("clustered", [False, True])
def test_hard_negatives(session, clustered):
    rng = np.random.default_rng(8)
    n = 3000
    vectors = rng.normal(size=(n, 12))
    if clustered:
        vectors = rng.normal(size=(15, 12))[rng.integers(0, 15, n)] * 2 + rng.normal(size=(n, 12)) * 0.1
    vectors[500:900] = vectors[500]  # a hot group of equal vectors
    vectors[::300] *= 40
    rows = [(int(i - 200), v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(vectors.astype(np.float32))]
    rows += rows[:300] * 3  # repeated rows
    rows += [(None, [1.0] * 12, 1), (7001, None, 1), (7002, [1.0] * 12, None), (7003, [float("nan")] * 12, 1),
             (7004, [float("inf")] * 12, 1), (7005, [None] * 12, 1), (7006, [], 1), (7100, [3.0, -1.0], 2)]
    assert found_negatives(session, rows, block=64, group=16) == mined(rows, 12)


def test_hard_negatives_of_odd_tables(session):
    assert not found_negatives(session, [])
    assert not found_negatives(session, [(100, [1.0], 1)]) and not found_negatives(session, [(101, [1.0], 1)])
    few = [(100, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [0.5, 1.0], 2), (3, [0.5, 1.0], 2), (4, [-1.0, 0.0], 2)]
    assert found_negatives(session, few) == mined(few, 2)
    large = [(100, [2.0**20, 0.5], 1), (1, [2.0**20, 1.0], 1), (2, [2.0**19, 0.5], 2)]
    assert found_negatives(session, large) == mined(large, 2)


def test_zone_maps_choose_blocks():
    rng = np.random.default_rng(2)
    box = rng.integers(-50, 50, (40, 6))
    low, high = box.min(0), box.max(0)
    anchors = rng.integers(-9, 9, (5, 6))
    least, most = hard_negatives.bounds(anchors, low[None, :], high[None, :])
    score = anchors @ box.T
    assert (least[:, 0] <= score.min(1)).all() and (score.max(1) <= most[:, 0]).all()
    cells = np.indices((4, 4, 4)).reshape(3, -1).T
    order = cells[np.argsort(hard_negatives.hilbert(cells, 2))]
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()
