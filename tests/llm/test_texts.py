"""Quality rules, personal data, mixing, language models and classifiers."""

import hashlib
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortix.llm import langid, lmscore, mixing, pii, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_repeats(words):
    found = {}
    for i in range(len(words) - 4):
        found.setdefault(tuple(words[i : i + 5]), []).append(i)
    return len({j for v in found.values() if len(v) > 1 for i in v for j in range(i, i + 5)})


def test_measurements(odd_texts):
    rng = np.random.default_rng(0)
    texts = odd_texts + [" ".join(rng.choice(list("abc"), n)) for n in range(0, 60, 3)] + ["l1\nl2\nl1\n \nl1 \n\nL!! #$"]
    for t in texts:
        m = dict(zip(quality.MEASURES, quality.measure(t), strict=True))
        words = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert (m["n_words"], m["word_chars"], m["n_symbols"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")))
        assert m["n_dup_lines"] == len(lines) - len(set(lines)) and m["n_repeat_words"] == plain_repeats(words)


def test_ledger_policies_and_ablation(spark, make_docs, odd_texts):
    docs = make_docs([*odd_texts, "A clean text of more than ten quite ordinary words, written once."], extra=["kept", "failures"])
    book = quality.ledger(docs)
    full = quality.apply_policy(book, "full-1")
    kept = {r["doc_id"] for r in full.filter("kept").collect()}
    assert kept == {9} == {r["doc_id"] for r in quality.filter_documents(docs).collect()}
    assert quality.filter_documents(docs).columns == docs.columns
    masks = [r["failures"] for r in book.collect()]
    for r in quality.ablate(book, "full-1").collect():
        bit, mask = 1 << quality.RULES[r["rule"]][0], quality.policy_mask("full-1")
        assert r["n_failed"] == sum(bool(m & bit) for m in masks) and r["n_only"] == sum(m & mask == bit for m in masks)
        assert r["n_kept_without"] == sum(m & (mask & ~bit) == 0 for m in masks)
    assert quality.ledger(docs.limit(0)).count() == 0
    assert quality.ledger(docs.unionByName(docs)).count() == 2 * docs.count()


def test_filter_follows_the_mask(spark, make_docs, odd_texts, monkeypatch):
    docs = make_docs([*odd_texts, "A clean text of more than ten quite ordinary words, written once."])
    masks = {r["doc_id"]: r["failures"] for r in quality.ledger(docs).collect()}
    for bit, _ in quality.RULES.values():
        monkeypatch.setattr(quality, "policy_mask", lambda policy, bit=bit: 1 << bit)
        assert {r["doc_id"] for r in quality.filter_documents(docs).collect()} == {i for i, m in masks.items() if not m & 1 << bit}


def plain_spans(text):
    kinds = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
    out = []
    for k, (kind, expression) in enumerate(kinds):
        for m in re.finditer(expression, text):
            d = [int(c) for c in m.group(0) if c in "0123456789"]
            doubled = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
            fine = {"email": True, "ip": all(int(p) <= 255 for p in m.group(0).split(".")) if kind == "ip" else False, "card": 14 <= len(d) <= 19 and doubled % 10 == 0, "phone": 10 <= len(d) <= 15}[kind]
            if fine:
                out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


PII = [
    "mail a.b+c@x-y.example.com, b@c.d_e@f.g and @no.x", "at 1.2.3.4.5.6.7.8 or 300.1.1.1 or 0001.2.3.255", "card 4111 1111 1111 1111 or 4111-1111-1111-1112 x",
    "call +1 (555) 010-9999 or +12 or +49 30 1234567-", "😀 ü +1 (555) 010-9999 4111111111111111 end", "none", None, "", "9" * 3000 + "@" + "a" * 3000, "a.b@" * 200, "1.2.3" * 50,
]


def test_exact_spans(spark, make_docs):
    out = {r["doc_id"]: r for r in pii.detect(make_docs(PII, extra=["spans", "kind"])).collect()}
    assert len(out) == len(PII)
    for i, t in enumerate(PII):
        want = plain_spans(t or "")
        assert out[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), t
        assert set(want.split(",")) - {""} <= set(out[i]["spans"].split(","))
        assert [out[i][f"n_{k}"] for k in pii.KINDS] == [want.count(k + ":") for k in pii.KINDS]
    assert pii.detect(make_docs(PII).limit(0)).count() == 0


def card_number(i):
    """A 16-digit number with the right check digit."""
    body = f"41111111111{i:04d}"
    total = sum(x if k % 2 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(int(c) for c in reversed(body)))
    return body + str(-total % 10)


def test_patterns_discover_what_the_rules_miss(spark, make_docs):
    seeds = [f"write to +1 (55{i}) 010-99{i}{i} today please" for i in range(10)] + [f"paid with {card_number(i)} and left" for i in range(10)]
    hidden = "reach +1 (551) 010-9876 4111111111111111 there"
    docs = make_docs([*seeds, hidden, "the year 1999 and version 4.0."])
    out = {r["doc_id"]: r["spans"] for r in pii.detect(docs).collect()}
    assert out[20] == "phone:6:23,card:24:40" and out[21] == ""
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert clean[20] == "reach [PHONE] [CARD] there" and clean[21] == "the year 1999 and version 4.0."
    twice = pii.detect(docs.unionByName(docs)).collect()
    assert sorted((r["doc_id"], r["spans"]) for r in twice) == sorted((i, s) for i, s in out.items() for _ in "xx")


def test_context_proposes_new_shapes(spark, make_docs):
    """After a word that seeds of one kind follow, windows of a shape that no seed has; not after other words, nor what fails the kind's check."""
    seeds = [f"call +1 (55{i}) 010-99{i}{i} now" for i in range(10)] + [f"paid {card_number(i)} and left" for i in range(5)]
    n = card_number(7)
    texts = [*seeds, "call 555-0199-2233 now", f"paid {n[:4]}.{n[4:8]}.{n[8:12]}.{n[12:]} and left", "code 555-0199-2233 now", "paid 4111.1111.1111.1112 and left"]
    out = {r["doc_id"]: r["spans"] for r in pii.detect(make_docs(texts)).collect()}
    assert [out[i] for i in range(15, 19)] == ["phone:5:18", "card:5:24", "", ""]


def test_pii_stays_in_the_jvm(spark, make_docs):
    plan = pii.detect(make_docs(PII))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def water(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w, full = {s: weights[i % 3] for i, s in enumerate(names)}, set()
    while True:
        rest, share = sum(sizes.values()) - sum(most * sizes[s] for s in full), sum(w[s] for s in names if s not in full)
        new = {s for s in names if s not in full and rest * w[s] / share > most * sizes[s]}
        if not new:
            return {s: most * sizes[s] if s in full else rest * w[s] / share for s in names}
        full |= new


def test_mixing_targets_and_plan(spark, make_docs):
    rng = np.random.default_rng(2)
    rows = [(" ".join("w" * int(n)), None, [None, "a", "b", "c", "d"][int(rng.choice(5, p=[0.05, 0.6, 0.05, 0.1, 0.2]))]) for n in rng.integers(0, 40, 900)]
    docs = make_docs([*rows, (None, None, "b")], extra=["size", "target"])
    out = mixing.plan(docs).toPandas()
    assert len(out) == 901
    sizes = {}
    for text, _, source in [*rows, (None, None, "b")]:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = water(sizes)
    for source, total in sizes.items():
        own = out[out["source"].isna()] if source is None else out[out["source"] == source]
        assert np.isclose(own["target"], want[source]).all() and (own["source_size"] == total).all()
        assert abs(own["taken"].sum() - want[source]) <= 40
    assert (out["taken"] <= 3 * out["size"]).all() and (out["shards"].map(len) == out["copies"].where(out["size"] > 0, out["shards"].map(len))).all()
    again = mixing.plan(docs.repartition(7)).toPandas()
    assert dict(zip(out["doc_id"], out["taken"], strict=True)) == dict(zip(again["doc_id"], again["taken"], strict=True))
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == {i: c for i, c, s in zip(out["doc_id"], out["copies"], out["size"], strict=True) if c}
    assert mixing.plan(docs.limit(0)).count() == 0 == mixing.mix_documents(docs.limit(0)).count()


def test_the_tree_decides_what_is_taken(spark, make_docs, monkeypatch):
    """Without the tree's draws nothing is taken; with those of some shards only, only what these draw; tables too long to broadcast give the same."""
    docs = make_docs([("w " * (i % 9 + 1), None, f"s{i % 3}") for i in range(300)])
    whole = {r["doc_id"]: r for r in mixing.plan(docs).collect()}
    original = mixing.shard_draws
    monkeypatch.setattr(mixing, "shard_draws", lambda *a: original(*a).filter("shard % 2 = 0"))
    some = {r["doc_id"]: r for r in mixing.plan(docs).collect()}
    assert all(some[i]["shards"] == [x for x in r["shards"] if x % 2 == 0] and some[i]["taken"] == r["size"] * len(some[i]["shards"]) for i, r in whole.items())
    assert 0 < sum(r["taken"] for r in some.values()) < sum(r["taken"] for r in whole.values())
    monkeypatch.setattr(mixing, "shard_draws", original)
    monkeypatch.setattr(mixing, "MOST_BROADCAST", 0)
    monkeypatch.setattr(mixing, "GROUP", 2)
    assert {r["doc_id"]: r["taken"] for r in mixing.plan(docs).collect()} == {i: r["taken"] for i, r in whole.items()}


def test_draws_above_the_generators_range():
    """Quotas above 1e9 are drawn exactly: mean and variance of the hypergeometric law, within its support."""
    rng = np.random.default_rng(1)
    good, bad, draws = 3 * 10**9, 5 * 10**9, 2 * 10**9
    x = np.array([mixing.hypergeometric(rng, good, bad, draws) for _ in range(400)], float)
    n = good + bad
    mean, variance = draws * good / n, draws * (good / n) * (bad / n) * (n - draws) / (n - 1)
    assert abs(x.mean() - mean) < 4 * (variance / 400) ** 0.5 and 0.75 < x.var() / variance < 1.3
    assert mixing.hypergeometric(rng, 2 * 10**9, 0, 5) == 5 and mixing.hypergeometric(rng, 10**10, 10**10, 2 * 10**10) == 10**10
    quota = np.array([4 * 10**9, 7, 2 * 10**9])
    parts = [mixing.split_quota(quota, s, 5, 3) for s in range(5)]
    assert (sum(q for _, q in parts) == quota).all()


def test_groups_of_sources_split_alike():
    """The vector of a group follows the draws of the groups' sums, whatever its place."""
    vectors = [np.array([50, 3, 20]), np.array([7]), np.array([100, 100])]
    sums = np.array([v.sum() for v in vectors])
    for shard in range(6):
        sizes = [mixing.split_quota(v, shard, 6, 1, sums, g)[1].sum() for g, v in enumerate(vectors)]
        assert abs(sum(sizes) - sums.sum() / 6) <= 3
    for g, v in enumerate(vectors):
        assert (sum(mixing.split_quota(v, s, 6, 1, sums, g)[1] for s in range(6)) == v).all()


def test_splitting_tree_is_exact():
    quota = np.array([7, 0, 100, 13, 1000])
    for n in (1, 2, 5, 16):
        parts = [mixing.split_quota(quota, s, n, 9) for s in range(n)]
        assert (sum(q for _, q in parts) == quota).all()
        at = np.zeros_like(quota)
        for start, q in parts:
            assert (start == at).all()
            at = at + q
        totals = [int(q.sum()) for _, q in parts]
        assert max(totals) - min(totals) <= np.ceil(np.log2(n)) + 1


def test_word_count(spark, make_docs, odd_texts):
    out = {r["doc_id"]: r["n"] for r in make_docs(odd_texts).select("doc_id", mixing.word_count(F.col("text")).alias("n")).collect()}
    assert [out[i] for i in range(len(odd_texts))] == [len(WORD.findall(t or "")) for t in odd_texts]


def test_lm_scores(spark, make_docs, odd_texts):
    rng = np.random.default_rng(1)
    en, fr = "the of and to in is that it was for".split(), "le la de et un une dans que qui est".split()
    texts = [" ".join(rng.choice(en if i % 2 else fr, 60)) for i in range(300)] + odd_texts
    docs = make_docs(texts, extra=["score", "words"])
    out = {r["doc_id"]: r for r in lmscore.score_documents(docs).collect()}
    assert len(out) == len(texts)
    tokens = {i: [*((t or "").encode().lower().split()), b""] for i, t in enumerate(texts)}
    counts = Counter(w for i, ws in tokens.items() if not out[i]["held_out"] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        base = sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert out[i]["n_tokens"] == len(ws) and out[i]["n_known"] == sum(counts[w] > 0 for w in ws) and out[i]["train_tokens"] == n and np.isclose(out[i]["base_score"], base)
        assert np.isfinite(out[i]["score"]) and out[i]["score"] <= 0
    held = [r for i, r in out.items() if r["held_out"] and i < 300]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    twice = lmscore.score(docs.unionByName(docs), lmscore.train(docs)).groupBy("doc_id").agg(F.max("n_known").alias("a"), F.min("n_known").alias("b"), F.count("*").alias("n")).collect()
    assert all(r["a"] == r["b"] <= len(tokens[r["doc_id"]]) and r["n"] == 2 for r in twice)
    assert lmscore.score_documents(docs.limit(0)).count() == 0


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    m = lmscore.Model([b"a"], {b"a": 5, b"b": 3, b"": 2})
    weights = rng.standard_normal((lmscore.FEATURES, lmscore.CLASSES)).astype(np.float32)
    _, counts, _, index, _, rare = m.rows(["a b c", "", "b a zz a"])
    assert rare == [b"c", b"zz"]
    z, e, total = lmscore.logits(weights, index)
    assert counts == [4, 1, 5] and np.allclose((e / total[:, None]).sum(axis=1), 1, atol=1e-5) and np.allclose(np.exp(z).sum(axis=1), total, rtol=1e-4)

def test_word_weights_against_brute_force():
    """Probabilities of a bucket's words by the definition: shares times exp(weight), summed over every word of the class."""
    rng = np.random.default_rng(3)
    words = [bytes([a, b]) * 2 for a in b"abcdefgh" for b in b"xyz"]
    frequent = {w: int(c) for w, c in zip(words, rng.integers(3, 90, len(words)), strict=True)}
    m = lmscore.Model(words[:1], frequent)
    n = sum(frequent.values())
    texts = [" ".join(w.decode() for w in rng.choice(words, 40)) + " rareword" for _ in range(30)]
    buckets = lmscore.Buckets(n, 3 * lmscore.BUCKET)
    common = np.zeros(len(words) + 1, bool)
    t = m.read(texts)
    at, keys = buckets.keys(t, common)
    docs = np.repeat(np.arange(len(texts)), t.counts)[at]
    flags = np.where(docs < 20, lmscore.TRAINS | lmscore.ASKED, lmscore.ASKED)
    kinds = np.array([*m.kinds])
    room = np.array([sum(frequent[w] for w, k in zip(words, m.kinds, strict=False) if k == c) + 3.0 for c in range(lmscore.CLASSES)])
    shares = (np.array([*frequent.values(), 0]) + 0.5) / room[kinds]
    parts = list(lmscore.packed_block(keys, (docs << 2 | flags).astype(np.uint32), buckets))
    assert len(parts) == buckets.number == 3
    back = [lmscore.unpacked(data) for _, data in parts]
    assert Counter(np.repeat(np.concatenate([k for k, _, _ in back]), np.concatenate([n for _, _, n in back])).tolist()) == Counter(keys.tolist())
    got = np.zeros(len(texts))
    for _, data in parts:
        for _, sums in lmscore.applied([data], [7], shares):
            i, s = lmscore.unsqueezed(sums, np.uint32, np.int64)
            got[i] += s / lmscore.UNIT
    mask = np.uint64((1 << lmscore.PLACE_BITS) - 1)
    counts = Counter(keys[docs < 20].tolist())
    expected = np.zeros(len(texts))
    for slot in {k >> lmscore.PLACE_BITS for k in counts}:
        own = np.array(sorted(k for k in counts if k >> lmscore.PLACE_BITS == slot), np.uint64)
        weights = lmscore.WordWeights(own, np.array([counts[int(k)] for k in own]), shares)
        theta = {int(k & mask) - 1: w for k, w in zip(own, weights.theta, strict=True)}
        kind = int(slot) & ((1 << lmscore.CLASS_BITS) - 1)
        of_class = [i for i in range(len(words)) if m.kinds[i] == kind]
        rest = 1 - sum(shares[i] for i in of_class)
        z = rest + sum(shares[i] * np.exp(theta.get(i, 0.0)) for i in of_class)
        assert theta.get(-1, 0.0) == 0 and rest > 0
        total = sum(counts[int(k)] for k in own)
        for i, w in theta.items():
            if i >= 0:  # the gradient vanishes
                assert abs(counts[int(slot) << lmscore.PLACE_BITS | i + 1] - total * shares[i] * np.exp(w) / z - w / lmscore.VARIANCE) < 0.3
        for d, k in zip(docs.tolist(), keys.tolist(), strict=True):
            if k >> lmscore.PLACE_BITS == slot:
                expected[d] += theta.get(int(k) % (1 << lmscore.PLACE_BITS) - 1, 0.0) - np.log(z)
    assert np.allclose(got, expected, atol=0.01)


def test_frequent_words_have_a_bound(spark, monkeypatch):
    counts = spark.createDataFrame([(str(i).encode(), 1 + i // 10) for i in range(1000)], "word binary, n long")
    monkeypatch.setattr(lmscore, "MOST_HOT", 100)
    cut = lmscore.least_frequent(counts, 1 << 40)
    assert 0 < counts.filter(F.col("n") >= cut).count() <= 100


def test_lm_knows_a_copy_of_a_training_text(spark, make_docs):
    """Word pairs of training texts raise the score of their copies, whatever the order of the rows."""
    rng = np.random.default_rng(8)
    words = np.array([f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"])
    texts = [" ".join(rng.choice(words, 80)) for _ in range(300)]
    held = [i for i in range(300) if crc32(str(i).encode()) % 5 == 1]
    copied = held[: len(held) // 2]
    for i, j in zip(copied, (j for j in range(300) if j not in held), strict=False):
        texts[j] = texts[i]
    out = {r["doc_id"]: r["score"] for r in lmscore.score_documents(make_docs(texts)).collect()}
    assert min(out[i] for i in copied) > max(out[i] for i in held if i not in copied)


def test_toxicity(spark, make_docs):
    rng = np.random.default_rng(4)
    common = [f"word{i}" for i in range(60)]
    rows, marks = [], []
    for i in range(900):
        words = list(rng.choice(common, 30))
        toxic = i % 8 == 0
        if toxic:
            words[3:3] = rng.choice(["scoundrel", "vermin", "dunce"], 2)
        rows.append(" ".join(words))
        if i % 2 == 0:
            marks.append((i, int(toxic)))
    docs = make_docs([*rows, None, "", "!!! 123"], extra=["score"])
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity.classify(docs, labels).collect()}
    assert len(out) == 903 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out.values())
    held = [(r["predicted"], i % 8 == 0) for i, r in out.items() if i < 900 and r["held_out"]]
    assert sum(p == t for p, t in held) / len(held) > 0.98
    assert all(out[i]["predicted"] == 0 for i in (900, 901, 902))
    assert {r["score"] for r in toxicity.classify(docs, labels.limit(0)).collect()} == {toxicity.classify(docs, labels.limit(0)).first()["score"]}
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def test_toxicity_with_ids_as_text(spark, make_docs):
    """Ids may be text, and an id may have several texts and labels."""
    docs = make_docs([("dunce " * 3 if i % 4 == 0 else "plain words ") + f"w{i % 5} here" for i in range(160)])
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    labels = spark.createDataFrame([(f"d{i}", int(i % 4 == 0)) for i in range(0, 160, 2)] + [("d0", 0)], "doc_id string, toxic int")
    out = toxicity.classify(named.unionByName(named.limit(3)), labels).collect()
    assert len(out) == 163 and all(0 <= r["score"] <= 1 and r["doc_id"].startswith("d") for r in out)


def test_language(spark, make_docs):
    rng = np.random.default_rng(5)
    vocabulary = {"en": "the house with thought weather nothing", "de": "das haus mit gedanken wetter nichts schön", "fr": "la maison avec pensée temps rien être", "es": "la casa con pensamiento tiempo nada niño"}
    rows = [(" ".join(rng.choice(words.split(), 12)), lang if i % 10 else None, "s") for i in range(100) for lang, words in vocabulary.items()]
    docs = make_docs([*rows, (None, "en", "s"), ("12 !", "en", "s"), ("", None, "s")], extra=["lang_pred"])
    out = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    truth = [lang for _ in range(100) for lang in vocabulary]
    assert np.mean([out[i]["lang_pred"] == t for i, t in enumerate(truth) if out[i]["held_out"]]) > 0.97
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (400, 401, 402))
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert {r["lang_pred"] for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    only = langid.identify(docs.filter("lang = 'en'"))
    assert {r["lang_pred"] for r in only.collect()} <= {"en", "und"}
    assert langid.identify(docs.limit(0)).count() == 0


def test_held_out_rule(spark):
    import zlib

    ids = list(range(200))
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    for module in (lmscore, toxicity, langid):
        divisor, remainder = module.HELD_OUT
        got = {r["doc_id"] for r in df.filter(module.held_out(F.col("doc_id"))).collect()}
        assert got == {i for i in ids if zlib.crc32(str(i).encode()) % divisor == remainder}


@pytest.mark.parametrize("policy", list(quality.POLICIES))
def test_policies_name_rules(policy):
    assert set(quality.POLICIES[policy]) <= set(quality.RULES)


def test_rows_without_an_id(spark, make_docs):
    """Null ids come through every operator, and beside them large ids keep all their digits."""
    from cohortix.llm import flac, ngramjoin, packing

    large = 2**53 + 1
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(large, text, "en", "s", 5), (None, text, None, None, None), (None, None, "fr", "t", 1), (7, text + " more", "fr", "s", 2)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(7, 1), (None, 0), (large, None)], "doc_id long, toxic int")
    outputs = [quality.ledger(docs), pii.detect(docs), mixing.plan(docs), lmscore.score_documents(docs), toxicity.classify(docs, labels), langid.identify(docs), flac.read_media(flac.to_media(docs)), ngramjoin.join(docs), packing.pack(docs)]
    for out in outputs:
        assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(["None", "None", str(large), "7"])
    assert sorted(str(r["doc_id"]) for r in ngramjoin.one_of_each(docs).collect()) == ["7", "None"]  # 8 of 9 shingles are shared
    assert quality.filter_documents(docs).count() == 3 and pii.redact(docs).count() == 4 and mixing.mix_documents(docs).count() >= 3
