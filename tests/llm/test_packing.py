import zlib

import numpy as np
import pytest

from cohortix.llm import packing


def check(rows, texts, tokens, capacity=packing.CAPACITY):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["piece"])
        ids = tokens[doc_id]
        assert [p["piece"] for p in pieces] == list(range(-(-len(ids) // capacity)))
        at = 0
        for p in pieces:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids) and all(p["length"] == capacity for p in pieces[1:])
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        at = 0
        for p in pieces:
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    return len(by_sequence)


def tokens_of(texts):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4") for i, x in texts.items()}


def test_pack_is_whole_and_tight(spark, make_docs, odd_texts):
    rng = np.random.default_rng(0)
    texts = odd_texts + [" ".join(["word", "Satz", "l'été"][k] for k in rng.integers(0, 3, n)) for n in rng.integers(1, 900, 300)]
    out = packing.pack(make_docs(texts, extra=["block", "length"])).collect()
    tokens = tokens_of(dict(enumerate(texts)))
    n = check(out, dict(enumerate(texts)), tokens)
    plain: list[int] = []  # best fit decreasing over all pieces at once
    for size in sorted((x for ids in tokens.values() for x in packing.cut(len(ids), 1024)), reverse=True):
        room = [i for i, f in enumerate(plain) if f + size <= 1024]
        if room:
            plain[max(room, key=plain.__getitem__)] += size
        else:
            plain.append(size)
    assert n <= len(plain) * 1.01 + 1


def test_repeated_rows_and_empty_table(spark, make_docs):
    docs = make_docs(["a b c", "d " * 1500])
    out = packing.pack(docs.unionByName(docs)).collect()
    one = packing.pack(docs).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"]) for r in out) == sorted([(r["doc_id"], r["piece"], r["length"]) for r in one] * 2)
    fill = {}
    for r in out:
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in fill.values():
        spans.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False)) and sum(n for _, n in spans) <= 1024
    assert packing.pack(docs.limit(0)).count() == 0


def test_same_ids_as_tokenizers():
    text = "Hello  world\n\n\tÜber 123456 <|endoftext|>   end 😀" + "z" * 5000
    assert packing.encoder()(text.replace("<|endoftext|>", "")) == tokens_of({0: text.replace("<|endoftext|>", "")})[0][:-1].tolist()


def test_crossover_and_mutation_keep_every_piece():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1024, 200)
    parents = [packing.decode(packing.evolve(lengths, [], s, 1024, 0), lengths) for s in (0, 1)]
    for _ in range(10):
        bins, fill = packing.mutate(packing.crossover(*parents, lengths, 1024, rng), lengths.tolist(), 1024, rng, 5)
        assert sorted(i for b in bins for i in b) == list(range(200)) and max(fill) <= 1024 and fill == [int(lengths[b].sum()) for b in bins]


def test_the_fullest_subset_is_the_best():
    from itertools import combinations

    rng = np.random.default_rng(5)
    for _ in range(50):
        lengths = sorted(rng.integers(1, 60, 9).tolist(), reverse=True)
        got = packing.fullest(lengths, list(range(9)), 100)
        sums = [sum(lengths[i] for i in c) + lengths[0] for k in range(9) for c in combinations(range(1, 9), k)]
        assert got[0] == 0 and len(set(got)) == len(got) and sum(lengths[i] for i in got) == max(x for x in sums if x <= 100)


def test_evolution_beats_best_fit():
    """Blocks on which best fit decreasing leaves bins above the floor: islands, crossover and mutation save some, and more than no generations do."""
    rng = np.random.default_rng(11)
    saved = []
    for _ in range(6):
        lengths = rng.integers(150, 700, 400)
        bins, fill = [], []
        packing.best_fit(lengths, sorted(range(400), key=lambda i: (-lengths[i], i)), bins, fill, 1024)
        genomes = [packing.evolve(lengths, [], s, 1024, packing.GENERATIONS) for s in range(2)]
        genomes = [packing.evolve(lengths, [genomes[i], genomes[1 - i]], 100 + i, 1024, packing.GENERATIONS) for i in range(2)]
        best = min(int(g.max()) + 1 for g in genomes)
        assert -(-int(lengths.sum()) // 1024) <= best <= len(bins)
        saved.append(len(bins) - best)
    assert sum(saved) >= 6


def test_ids_of_many_partitions():
    """Sequences of partition 40,000 and beyond fit a long, and none is named twice."""
    found = set()
    for part in (0, 1, 40_000, (1 << 24) - 1):
        for number in (0, 7, (1 << 24) - 1):
            ids = packing.sequence_ids(packing.block_id(part, number), np.array([0, 5, (1 << 15) - 1]))
            assert ids.dtype == np.int64 and (ids >= 0).all()
            found.update(ids.tolist())
    for block in (-1, -10_000):
        found.update(packing.sequence_ids(block, np.array([0, 5, (1 << 15) - 1])).tolist())
    assert len(found) == 3 * (12 + 2)
    with pytest.raises(ValueError):
        packing.block_id(1 << 24, 0)
