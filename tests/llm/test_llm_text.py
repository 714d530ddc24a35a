"""Operators on single texts: tokens, language, toxicity, quality, shards."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from corpus_rows import odd_rows
from pyspark.sql import functions as F

import public_tokenizers
from pulsegrid.llm import bpe, langid, quality, sharding, toxicity
from pulsegrid.llm.arrow import Words, grams, pack, pack_sorted, unpack, unpack_sorted, views
from pulsegrid.llm.sample import drawn

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_words_and_packing():
    texts = ["a b", None, "", " x\x85y\t", "héé a"]
    words = Words(*views(pa.array(texts)))
    found = [words.data[a:b].tobytes().decode() for a, b in zip(words.start, words.end, strict=True)]
    assert found == ["a", "b", "x\x85y", "héé", "a"] and words.of.tolist() == [0, 2, 2, 2, 3, 5]
    hashes = words.hashes()
    assert hashes[0] == hashes[4] and len(set(hashes.tolist())) == 4
    assert len(grams(hashes, 6)) == 0 and len(grams(hashes, 2)) == 4
    values = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (unpack_sorted(pack_sorted(values)) == values).all() and (unpack(pack(values)) == values).all()
    assert len(unpack(pack(values[:0]))) == 0


@pytest.fixture(scope="module")
def tokenizer():
    encoder = bpe.Encoder(dict(bpe.encoder(PATH, public_tokenizers.PATTERN).ranks), public_tokenizers.PATTERN)
    other = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    return encoder, other


def test_bpe_equals_tiktoken(tokenizer):
    encoder, other = tokenizer
    rng = random.Random(5)
    signs = ["'", "s", "t", "r", "e", "v", "l", "d", "m", " ", "\n", "\t", "é", "漢", "1", "²", "!", "\x1c", "\x85", "ab"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(15))) for _ in range(3000)]
    texts += ["", "a" * 20_000, " " * 3000 + "x", "Ωß漢" * 700, "<|endoftext|>"]
    data, offsets = views(pa.array(texts))
    for text, ids in zip(texts, encoder.encode_views(data, offsets), strict=True):
        assert ids.tolist() == other.encode_ordinary(text)
        assert encoder.decode(ids.tolist()) == text.encode()
    assert encoder.encode_alone("'sofa  x".encode()).tolist() == other.encode_ordinary("'sofa  x")
    plain = bpe.Encoder(encoder.ranks, r"\S+|\s+")
    plain_other = tiktoken.Encoding("p", pat_str=r"\S+|\s+", mergeable_ranks=encoder.ranks, special_tokens={})
    assert all(plain.encode(t) == plain_other.encode_ordinary(t) for t in texts[:500])


def test_bpe_keeps_rank_order_in_odd_vocabularies():
    """A merge may bring up a pair that ranks lower; it goes first, though equal pairs wait further right."""
    rng = random.Random(9)
    for _ in range(60):
        parts = {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(14)}
        names = [bytes([b]) for b in b"abc"] + sorted(parts)
        ranks = list(range(len(names)))
        rng.shuffle(ranks)
        vocabulary = dict(zip(names, ranks, strict=True))
        encoder = bpe.Encoder(vocabulary, r"[abc]+")
        other = tiktoken.Encoding("o", pat_str="[abc]+", mergeable_ranks=vocabulary, special_tokens={})
        for _ in range(40):
            text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 25)))
            assert encoder.encode(text) == other.encode_ordinary(text)


def test_bpe_rejects_unknown_bytes():
    with pytest.raises(ValueError):
        bpe.Encoder({b"a": 0}, r".+").encode("ab")


def test_bpe_on_tables(make, tokenizer):
    _, other = tokenizer
    rows = odd_rows(random.Random(1))
    out = bpe.encode(make(rows), PATH, public_tokenizers.PATTERN, "text", ["doc_id"])
    want = Counter()
    for doc, text, *_ in rows:
        ids = other.encode_ordinary(text or "")
        want[doc, tuple(ids), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.n_tokens, r.ids_sha256, r.decoded_sha256)
                   for r in out.collect()) == want
    back = bpe.decode(out, PATH, public_tokenizers.PATTERN, "ids", ["doc_id"])
    assert Counter((r.doc_id, bytes(r.text_bytes).decode()) for r in back.collect()) == Counter(
        (d, t or "") for d, t, *_ in rows)
    assert bpe.encode(make([]), PATH, public_tokenizers.PATTERN, "text", ["doc_id"]).count() == 0


def test_language(make):
    rng = random.Random(2)
    letters = {"aa": "abcdab", "bb": "xyzwxy", "cc": "klmnéü"}
    text = lambda s: " ".join("".join(rng.choice(letters[s]) for _ in range(5)) for _ in range(20))
    rows = [(i, text(s), s) for i, s in enumerate(list(letters) * 60)]
    model = langid.train(make(rows), "text", "lang", "doc_id")
    assert model.languages == ["aa", "bb", "cc"]
    tests = [(1000 + i, text(s), s) for i, s in enumerate(list(letters) * 20)]
    odd = [(1, None), (2, ""), (3, "12 !!"), (None, "abab"), (4, "xyzw " * 20_000)]
    got = {r.doc_id: r for r in langid.identify(make(tests + odd), model, "text", ["doc_id"]).collect()}
    right = sum(got[d].lang_pred == s for d, _, s in tests)
    assert right >= 0.95 * len(tests)
    assert [got[d].lang_pred for d in (1, 2, 3, 4)] == ["und", "und", "und", "bb"]
    assert [got[d].score for d in (1, 2, 3)] == [0, 0, 0] and all(0 <= r.score <= 1 for r in got.values())
    nothing = langid.train(make([(1, None, "aa"), (2, "x", None)]), "text", "lang", "doc_id")
    assert {r.lang_pred for r in langid.identify(make(tests), nothing, "text", ["doc_id"]).collect()} == {"und"}
    assert langid.identify(make([]), model, "text", ["doc_id"]).count() == 0
    # A text scores the same alone and among others.
    texts = [t for _, t, _ in tests]
    together = langid.score_batch(model, pa.array(texts))[0]
    assert np.allclose(together, [langid.score_batch(model, pa.array([t]))[0][0] for t in texts])


def test_toxicity_learns_pairs(make):
    """Insult and group together are toxic, either alone is not: linear weights can't say this."""
    rng = random.Random(3)
    fill = ["word%d" % i for i in range(300)]

    def row(i):
        kind = i % 4
        words = rng.sample(fill, 25) + [[], ["vermin"], ["group"], ["vermin!", "Group"]][kind]
        rng.shuffle(words)
        return i, " ".join(words), int(kind == 3)

    rows = [row(i) for i in range(800)]
    machine = toxicity.fit(toxicity.bags_of([r[1] for r in rows]), np.array([r[2] for r in rows]))
    tests = [row(i) for i in range(400)]
    scores = toxicity.score_batch(machine, pa.array([t[1] for t in tests]))
    assert np.mean((scores >= 0.3) == np.array([t[2] for t in tests])) > 0.97
    alone = [toxicity.score_batch(machine, pa.array([t[1]]))[0] for t in tests[:20]]
    assert np.allclose(alone, scores[:20])
    long = " ".join(fill[i % 300] for i in range(60_000))
    a, b = toxicity.score_batch(machine, pa.array([long, long + " vermin group"]))
    assert a < 0.3 <= b
    odd = toxicity.score(make([(1, None), (2, ""), (None, "vermin group")]), machine, "text", ["doc_id"]).collect()
    base = 1 / (1 + np.exp(-machine.bias))
    assert {r.doc_id: r.score for r in odd if r.doc_id} == pytest.approx({1: base, 2: base})
    assert toxicity.score(make([]), machine, "text", ["doc_id"]).count() == 0
    assert toxicity.score_batch(toxicity.fit([], np.array([])), pa.array(["x"]))[0] < 1e-6


@pytest.mark.parametrize("law", [lambda a, b: a == b, lambda a, b: a and b, lambda a, b: a != b])
def test_toxicity_learns_terms_that_tell_nothing_alone(law):
    rng = random.Random(3)
    fill = [f"w{i}" for i in range(300)]

    def row():
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = rng.sample(fill, 25) + ["zork!!!!!!!!!!"] * a + ["((blip"] * b
        rng.shuffle(words)
        return " ".join(words), int(law(a, b))

    texts, labels = zip(*[row() for _ in range(4000)], strict=True)
    labels = np.array(labels)
    machine = toxicity.fit(toxicity.bags_of(texts[:3000]), labels[:3000])
    scores = toxicity.score_batch(machine, pa.array(texts[3000:]))
    assert np.mean((scores >= 0.5) == labels[3000:]) > 0.97
    # The formula written out, term by term.
    number = {int(toxicity.bags_of([w])[0][0][0]): w for w in [*fill, "zork", "blip"]}
    for text, score in zip(texts[3000:3020], scores, strict=False):
        bare = Counter(w.strip("!(") for w in text.split())
        x = [np.log2(1 + bare[number[int(h)]]) if int(h) in number else 0.0 for h in machine.terms]
        z = machine.bias + sum(w * v for w, v in zip(machine.linear, x, strict=True))
        z += sum(float(machine.factors[i] @ machine.factors[j]) * x[i] * x[j] for i in range(len(x)) for j in range(i))
        assert score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
    signs = "!" * 60_000
    assert toxicity.bags_of([f"{signs}zork{signs} {signs}"])[0][0].tolist() == toxicity.bags_of(["zork"])[0][0].tolist()


def test_features_of_a_sample_are_two_arrays():
    texts = pa.chunked_array([["Some words of plain prose, said twice.", "", "ab"], ["x", "of a text with $$$ five"]])
    rows, shares, cuts = quality._bags(texts)
    assert rows.dtype == np.int32 and shares.dtype == np.float32 and len(rows) == len(shares) == cuts[-1]
    for i, text in enumerate(texts):
        data, offsets = quality.views(pa.array([text.as_py()]))
        some, counts = np.unique(quality._features(data), return_counts=True)
        measured = quality.measures(data, offsets)
        bins = [] if np.isnan(measured[0, 0]) else quality._bin_features(measured)[0].tolist()
        own = slice(cuts[i], cuts[i + 1])
        assert rows[own].tolist() == some.tolist() + bins
        assert np.allclose(shares[own], [*(counts / max(1, counts.sum())), *(1.0 for _ in bins)])


def test_quality(make):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8)))
    good = lambda: " ".join([word().capitalize()] + [word() for _ in range(80)]) + "."
    spoil = [lambda t: t.upper(), lambda t: " ".join(w + "$$$" for w in t.split()), lambda t: t.replace(" ", " | "),
             lambda t: " ".join(w for w in t.split()[:6] for _ in range(15))]
    rows = [(i, good()) if i % 5 else (i, spoil[i // 5 % 4](good())) for i in range(600)]
    scorer, model = quality.train(make(rows), "text", "doc_id")
    assert 0.7 < model.good < 0.9
    got = {r.doc_id: r for r in quality.classify(make(rows), scorer, model, "text", ["doc_id"]).collect()}
    assert all(got[i].kept for i, _ in rows if i % 5)
    assert sum(not got[i].kept for i, _ in rows if i % 5 == 0) >= 114
    odd = make([(1, None), (2, ""), (2, ""), (None, "x"), (3, "good word " * 30_000)])
    assert quality.classify(odd, scorer, model, "text", ["doc_id"]).count() == 5
    scorer, model = quality.train(make([]), "text", "doc_id")
    assert quality.classify(make([]), scorer, model, "text", ["doc_id"]).count() == 0


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(6)
    truth = rng.random(20_000) < 0.7
    right, caught = np.array([0.9, 0.95, 0.8]), np.array([0.7, 0.6, 0.9])
    good = rng.random((20_000, 3)) < right
    bad = rng.random((20_000, 3)) < caught
    cast = np.where(truth[:, None], good, ~bad).astype(int)
    patterns, counts = np.unique(cast, axis=0, return_counts=True)
    m = quality.estimate(patterns, counts)
    assert m.good == pytest.approx(0.7, abs=0.03)
    assert m.right == pytest.approx(right, abs=0.03) and m.caught == pytest.approx(caught, abs=0.05)


def test_sharding(make):
    rows = [(i, "t" * (i % 7)) for i in range(3000)] + odd_rows(random.Random(7))
    weights = [1.0, 2.0, 1.0]
    got = sharding.shard_records(make(rows), "doc_id", "text", weights, parts=16).collect()
    assert len(got) == len(rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 3)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = Counter(r.shard for r in got)
    assert counts[1] == pytest.approx(sum(counts.values()) / 2, rel=0.1)
    assert sum(r.grown_shard == 3 for r in got) == pytest.approx(len(rows) / 5, rel=0.2)
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r.key, r.size, r.text_crc32) for r in got) == want
    one = {r.key: r.shard for r in got}
    again = sharding.shard_records(make(rows[::-1][:500]), "doc_id", "text", weights, parts=4).collect()
    assert all(one[r.key] == r.shard for r in again)
    more = sharding.shard_records(make(rows), "doc_id", "text", [*weights, 1.0]).collect()
    grown = {r.key: r.grown_shard for r in got}
    assert all(grown[r.key] == r.shard for r in more)
    assert sharding.shard_records(make([]), "doc_id", "text", weights).count() == 0
    with pytest.raises(ValueError):
        sharding.winner(F.lit("x"), [1.0, 0.0])


def test_sharding_of_hot_keys_and_records(make, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    rows = [(None, f"text {i}") for i in range(400)] + [(5, "same")] * 300 + [(i, "x") for i in range(300)]
    weights = [1.0, 3.0, 0.5]
    got = sharding.shard_records(make(rows), "doc_id", "text", weights, new_weight=2.0, parts=8).collect()
    assert Counter((r.key, r.size, r.text_crc32) for r in got) == Counter(
        (d, len(t) + 1, zlib.crc32(t.encode())) for d, t in rows)

    def bids(key, weights):
        drawn = [int(hashlib.md5(f"{'' if key is None else key}:{i}".encode()).hexdigest()[:13], 16)
                 for i in range(len(weights))]
        return [-w / math.log((d + 0.5) / 2**52) for d, w in zip(drawn, weights)]

    for r in got:
        old, new = bids(r.key, weights), bids(r.key, [*weights, 2.0])
        assert (r.shard, r.grown_shard) == (old.index(max(old)), new.index(max(new)))
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    same = sorted(r.slot for r in got if r.key == 5 and r.size == 5)
    assert same == list(range(same[0], same[0] + 300))


def test_samples_are_bounded_and_repeatable(session):
    rows = session.range(50_000).repartition(16)
    first = {r.id for r in drawn(rows, 500, "id").collect()}
    again = {r.id for r in drawn(rows.repartition(3), 500, "id").collect()}
    assert len(first) == 500 and first == again
    assert drawn(session.range(10), 500, "id").count() == 10 and drawn(session.range(0), 5, "id").count() == 0
