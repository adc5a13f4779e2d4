"""Operators without SQL against brute force on small tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, decontaminate, fm_index, language, line_dedup, quality, sharding, simhash, suffix_core, suffix_dedup, token_blocks
from tessera.llm import catalog
from tessera.llm.common import work_path

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def groups(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_byte_bpe_equals_tiktoken(spark, sf_dir, texts):
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    for r in catalog.op2_byte_bpe(spark, sf_dir).collect():
        ids = np.array(encoding.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_letters_unknown_to_the_rank_library():
    import tiktoken

    ranks = byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.Codec(ranks, P.PATTERN)
    rng = random.Random(1)
    every = [c for c in range(1, 0x33480) if not 0xD800 <= c < 0xE000]
    for _ in range(150):
        text = "".join(chr(rng.choice(every)) if rng.random() < 0.7 else rng.choice(" a1!\n") for _ in range(120))
        assert codec.encode(text) == np.array(encoding.encode_ordinary(text), "<u4").tobytes()
        assert codec.decode(codec.encode(text)) == text.encode()


def test_token_files_equal_the_library(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    library, start = Tokenizer.from_file(P.path("word_bpe_49k.json")), 0
    got = {r.doc_id: r for r in catalog.op3_token_blocks(spark, sf_dir).collect()}
    for doc in sorted(texts):
        ids = np.array(library.encode(texts[doc], add_special_tokens=False).ids + [1], "<u4")
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.where(rng.random(n) < 0.1, rng.integers(0, 1 << 32, n), rng.integers(0, 300, n)).astype(np.uint32)
    reader = token_blocks.Reader(token_blocks.dump([4, None], [n // 2, n - n // 2], ids))
    assert (reader.ids() == ids).all() and (reader.ids(n // 3, n // 2) == ids[n // 3 :][: n // 2]).all()
    assert reader.doc_ids[0] == 4 and reader.null.tolist() == [False, True]


def test_fm_index_against_scans():
    rng = random.Random(3)
    for _ in range(60):
        symbols = rng.choice([1, 2, 5])
        s = [rng.randrange(symbols + 1) for _ in range(rng.randrange(1, 80))]
        index = fm_index.FMIndex(np.array(s), symbols + 1)
        m = rng.randrange(1, 4)
        patterns = np.array([[rng.randrange(1, symbols + 1) for _ in range(m)] for _ in range(8)])
        low, high = index.search(patterns)
        for p, a, b in zip(patterns.tolist(), low, high, strict=True):
            assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(len(s)) if s[i : i + m] == p]


def test_decontamination_in_blocks_is_the_same(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = decontaminate.digests(decontaminate.matches(docs, items))
    parts = decontaminate.digests(decontaminate.matches(docs, items, block_bytes=2000))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    clean = {r.doc_id for r in decontaminate.drop_contaminated(docs, items, block_bytes=2000).collect()}
    assert clean == {r.doc_id for r in whole.collect() if not r.contaminated}


def test_cut_spans():
    text = "One two, three. Four five".encode()
    assert decontaminate.cut_spans(text, [(1, 3)]) == b"One . Four five"


def repeated(docs):
    seen, out = set(), {}
    for i, t in sorted(docs):
        mask = np.zeros(len(t), bool)
        for p in range(len(t) - suffix_core.LENGTH + 1):
            w = t[p : p + suffix_core.LENGTH]
            if w in seen:
                mask[p : p + suffix_core.LENGTH] = True
            seen.add(w)
        kept = bytes(np.frombuffer(t, np.uint8)[~mask])
        spans = int((mask & ~np.concatenate([[False], mask[:-1]])).sum()) if len(t) else 0
        out[i] = (i, len(t), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest())
    return [out[i] for i in sorted(out)]


def test_suffix_dedup_on_documents(spark, sf_dir, texts):
    got = sorted(map(tuple, catalog.op5_suffix_dedup(spark, sf_dir).collect()))
    assert got == repeated([(i, t.encode()) for i, t in texts.items()])


def test_suffix_dedup_on_repetitive_texts(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(2, 8))) for _ in range(40)]
    passages = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(5)]
    docs = []
    for i in range(70):
        parts = []
        for _ in range(rng.randrange(5)):
            kind = rng.randrange(4)
            parts.append([rng.choice(passages)[rng.randrange(40) :], rng.choice("a x") * rng.randrange(300), (rng.choice(words) + "-") * rng.randrange(50), " ".join(rng.choice(words) for _ in range(40))][kind])
        docs.append((i, "".join(parts)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = sorted(map(tuple, suffix_dedup.repeats(df, bucket_bytes=10000).collect()))
    assert got == repeated([(i, t.encode()) for i, t in docs])


def test_suffix_sort_survives_hash_collisions(monkeypatch):
    raw = np.frombuffer(b"abcabdabcaaabbb" * 3, np.uint8)
    at, length = np.arange(30), np.full(30, 12)
    monkeypatch.setattr(suffix_core, "common_lengths", lambda h, r, x, y, most: np.minimum(most, 2))
    order, shared = suffix_core.suffix_sort(suffix_core.prefix_hashes(raw), raw, np.zeros(30, np.int64), at, length)
    found = [raw[i : i + 12].tobytes() for i in order]
    # Claimed extensions were too short everywhere: what is shared is at most what really is.
    assert len(set(order.tolist())) == 30 and all(a[:n] == b[:n] for a, b, n in zip(found, found[1:], shared[1:], strict=False))


def test_simhash_groups(spark, sf_dir, texts):
    ids = sorted(texts)
    prints = [simhash.fingerprint(texts[i].encode()) for i in ids]
    root = groups(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in catalog.op8_simhash(spark, sf_dir).collect()}
    assert got == {i: (f"{p:016x}", ids[root[k]]) for k, (i, p) in enumerate(zip(ids, prints, strict=True))}


def test_fingerprint_by_definition():
    import xxhash

    text = "A b  C d\te a b c d e"
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text.encode()) == want and simhash.fingerprint(b" \t") == 0


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_bit_sliced_links(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 64, 12, dtype=np.uint64)
    fp = np.array([base[rng.integers(12)] ^ sum((np.uint64(1) << np.uint64(b) for b in rng.integers(0, 64, rng.integers(0, 4))), np.uint64(0)) for _ in range(700)], np.uint64)
    bucket = np.sort(rng.integers(0, 5, 700))
    want = groups(700, [(a, b) for a in range(700) for b in range(a) if bucket[a] == bucket[b] and int(fp[a] ^ fp[b]).bit_count() <= radius])
    assert simhash.linked(bucket, fp, list(range(64)), radius).tolist() == want


def test_line_groups(spark):
    rng = random.Random(2)
    vowels = str.maketrans("0123456789", "aeioubcdfg")
    base = [" ".join(f"word{rng.randrange(400)}".translate(vowels) for _ in range(rng.choice([4, 8, 12, 30, 50, 70, 130, 200]))) for _ in range(25)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            words = rng.choice(base).split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = rng.choice(["other", "Word7", "x"])
            lines.append(rng.choice(["", "# ", ""]) + " ".join(words).title() + rng.choice([".", "!", ""]))
        docs.append((i, "\n".join(lines)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    import re

    import xxhash

    def norm(line):
        return re.sub("[0-9]+", "0", re.sub(r"[\x00-/:-`{-\x7f]+", " ", line.lower())).strip(" ")

    def blocks_of(line, blocks):
        """The SimHash of each block and how many words it has."""
        own = [[] for _ in range(blocks)]
        for w in dict.fromkeys(line.split(" ")):
            h = xxhash.xxh64_intdigest(w, 42)
            # Blocks share out the hashes, signed, in their order; a hash on a bound belongs to neither side.
            signed = h - (1 << 64) if h >> 63 else h
            own[sum(signed > (j << 64) // blocks - (1 << 63) for j in range(1, blocks))].append(h)
        bits = 8 * (line_dedup.LONE_SUMS if blocks >= 8 else line_dedup.PAIR_SUMS)
        places = [8 * i + k for i in range(8) for k in range(bits // 8)]
        return [(tuple(2 * sum(h >> b & 1 for h in hs) > len(hs) for b in places), len(hs)) for hs in own]

    def print_of(line):
        hashes = [xxhash.xxh64_intdigest(w, 42) for w in set(line.split(" "))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    def share_a_key(a, b):
        m = [len(set(x.split(" "))) for x in (a, b)]
        n = [len(x.split(" ")) for x in (a, b)]
        for blocks, least, most in line_dedup.TWO_OF:
            if least <= min(n) and max(n) <= most:
                x, y = blocks_of(a, blocks), blocks_of(b, blocks)
                same = [(p[1], q[1]) for p, q in zip(x, y) if p[0] == q[0]]
                if any((p[0] + q[0]) * blocks >= m[0] and (p[1] + q[1]) * blocks >= m[1] for i, p in enumerate(same) for q in same[:i]):
                    return True
        for t in range(8):
            if line_dedup.ONE_FROM << t <= min(n) and max(n) < line_dedup.ONE_TO << t:
                if any(p[0] == q[0] and p[1] and q[1] for p, q in zip(blocks_of(a, 8 << t), blocks_of(b, 8 << t))):
                    return True
        return False

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    found = [(i, n, norm(line)) for i, t in docs for n, line in enumerate(t.split("\n")) if norm(line)]
    first = {}
    for i, n, line in found:
        first.setdefault(line, (i, n))
    lines = list(first)

    def similar(a, b):
        most = int(max(len(lines[a]), len(lines[b])) * (1 - line_dedup.SIMILARITY) + 1e-9)
        return abs(len(lines[a]) - len(lines[b])) <= most and distance(lines[a], lines[b]) <= most

    def linked(a, b):
        n = min(len(lines[x].split(" ")) for x in (a, b))
        radius = [bits for least, bits in line_dedup.RADIUS if n >= least][-1]
        return (print_of(lines[a]) ^ print_of(lines[b])).bit_count() <= radius and share_a_key(lines[a], lines[b])

    alike = [(a, b) for a in range(len(lines)) for b in range(a) if similar(a, b)]
    root = groups(len(lines), [p for p in alike if linked(*p)])
    # Recall of the blocks: of all pairs of that edit similarity, and of those without that are in one group all the same.
    assert sum(linked(*p) for p in alike) >= 0.8 * len(alike)
    assert sum(root[a] == root[b] for a, b in alike) >= 0.95 * len(alike)
    keep = {}
    for k, line in enumerate(lines):
        keep[root[k]] = min(keep.get(root[k], (9**9, 0)), first[line])
    place = {line: k for k, line in enumerate(lines)}
    want = {i: [] for i, _ in docs}
    for i, n, line in found:
        if keep[root[place[line]]] != (i, n):
            want[i].append(n)
    got = {r.doc_id: r.dropped for r in line_dedup.decisions(df).collect()}
    assert got == want
    kept = {r.doc_id: r.text for r in line_dedup.drop_lines(df).collect()}
    assert kept == {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want[i]) for i, t in docs}


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = catalog.op9_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_finds_both_parts():
    rng = random.Random(1)
    words = {"en": "the of and to in is that it for".split(), "de": "der die und das ist nicht ein zu".split()}
    sample = {k: " ".join(rng.choice(w) for _ in range(3000)).encode() for k, w in words.items()}
    counts = np.stack([np.bincount(language.trigrams(np.frombuffer(sample[k], np.uint8)), minlength=language.BUCKETS) for k in ("de", "en")])
    model = language.Model(["de", "en"], counts.astype(float))
    mixed = sample["en"][:700] + sample["de"][:1400]
    share, _ = model.infer([mixed, sample["en"][:500]])
    assert share[0] == pytest.approx([2 / 3, 1 / 3], abs=0.08) and share[1].tolist() == [0, 1]
    assert not language.has_letter("12 !?".encode()) and language.has_letter("日".encode())


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = catalog.op4_quality(spark, sf).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.98


def test_factorisation_identity():
    rng = np.random.default_rng(1)
    machine = quality.Machine(0.3, rng.normal(size=quality.WIDTH), rng.normal(size=(quality.WIDTH, 3)))
    ids, x = rng.integers(0, quality.WIDTH, 9), rng.normal(size=9)
    pairs = sum(machine.factors[ids[i]] @ machine.factors[ids[j]] * x[i] * x[j] for i in range(9) for j in range(i))
    assert machine.margin(ids, x, np.array([9]))[0] == pytest.approx(0.3 + machine.linear[ids] @ x + pairs)


def test_labels_of_one_class_or_none(spark):
    docs = spark.createDataFrame([(1, "a b", 3), (2, "c", 1)], "doc_id bigint, text string, n_chars bigint")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, quality int")
    assert {round(r.score, 6) for r in quality.score(docs, quality.fit(docs, one)).collect()} == {round(2.5 / 3, 6)}


def test_compaction(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    store = sharding.ShardStore(spark, work_path(spark, "test"), target_bytes=120_000)
    for i in range(3):
        store.append(docs.where(F.col("doc_id") % 3 == i), rows=7)
    before, old = store.version(), {s["path"] for s in store.manifest()["shards"]}
    n = len(old)
    after = store.compact()
    shards = store.manifest()["shards"]
    # Shards that no run took stay live, so only the others may go.
    gone = old - {s["path"] for s in shards}
    assert after > before and len(shards) < n and max(s["bytes"] for s in shards) <= 1.3 * store.target
    assert store.read(before).drop("shard_file").exceptAll(store.read().drop("shard_file")).isEmpty()
    assert sorted(map(tuple, store.read().drop("shard_file").collect())) == sorted(map(tuple, docs.collect()))
    assert not store.runs(shards)
    with pytest.raises(sharding.Conflict):
        store.commit(before - 1, None, [])
    assert gone and store.vacuum() >= len(gone) and store.read().count() == docs.count()


def test_shard_query_places_every_document(spark, sf_dir, texts):
    got = {r.doc_id: r.text_sha256 for r in catalog.op6_sharding(spark, sf_dir).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}


def test_quality_scores_equal_pairwise_sums(spark, sf_dir):
    """Every row of op4: the same machine by sums over all pairs of features, features in plain Python."""
    import math
    from collections import Counter

    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = quality.fit(docs, labels, train_rows=~quality.held_out())
    again = quality.fit(docs.repartition(7), labels.repartition(3), train_rows=~quality.held_out())
    assert machine.bias == again.bias and (machine.linear == again.linear).all() and (machine.factors == again.factors).all()
    got = {r.doc_id: r for r in catalog.op4_quality(spark, sf_dir).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        tokens = quality.words((r.text or "").encode())
        counts = Counter(tokens)
        stats = quality.statistics((r.text or "").encode(), tokens, counts, r.n_chars)
        norm = max(1e-9, math.sqrt(sum(math.log1p(c) ** 2 for c in counts.values())))
        x = [(zlib.crc32(w) % quality.WORD_BUCKETS, math.log1p(c) / norm) for w, c in counts.items()]
        for k, v in enumerate(stats.tolist()):
            place = quality.WORD_BUCKETS + k * (quality.BINS + 1)
            x += [(place, v), (place + 1 + min(quality.BINS - 1, int(math.sqrt(min(1, max(0, v))) * quality.BINS)), 0.5)]
        x = x if len(x) < 400 else None
        if x is None:
            continue
        margin = machine.bias + sum(machine.linear[i] * v for i, v in x)
        factors = [machine.factors[i] * v for i, v in x]
        margin += sum(float(factors[a] @ factors[b]) for a in range(len(x)) for b in range(a))
        want = 1 / (1 + math.exp(-max(-30, min(30, margin))))
        assert got[r.doc_id].score == pytest.approx(want, abs=1e-6)
        assert got[r.doc_id].predicted == (got[r.doc_id].score >= 0.3)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_conflicting_labels_count_as_the_largest(spark):
    docs = spark.createDataFrame([(i, "good words" if i % 2 else "|| !! 99", 9) for i in range(40)], "doc_id bigint, text string, n_chars bigint")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(i, 0) for i in range(40)], "doc_id bigint, quality int")
    scores = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert min(s for i, s in scores.items() if i % 2) > max(s for i, s in scores.items() if not i % 2)


def test_language_equals_plain_expectation_maximisation(spark, sf_dir):
    """Every row of op9: segments, proportions and the choice of the set in plain Python, every size of set tried."""
    import math

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(docs, train=~language.held_out())
    m = len(model.languages)
    got = {r.doc_id: r for r in catalog.op9_language(spark, sf_dir).collect()}
    table = model.table.astype(np.float64)

    def proportions(parts, allowed):
        share = [1 / len(allowed) if k in allowed else 0.0 for k in range(m)]
        tops = [max(p) for p in parts]
        odds = [[math.exp(v - t) for v in p] for p, t in zip(parts, tops)]
        for _ in range(language.ROUNDS):
            new = [0.0] * m
            for o in odds:
                total = max(sum(a * b for a, b in zip(o, share)), 1e-300)
                new = [n + a * b / total for n, a, b in zip(new, o, share)]
            new = [max(n / len(parts), 1e-9) if k in allowed else 0.0 for k, n in enumerate(new)]
            share = [n / sum(new) for n in new]
        return share, sum(math.log(max(sum(a * b for a, b in zip(o, share)), 1e-300)) + t for o, t in zip(odds, tops))

    checked = 0
    for r in docs.collect():
        text, own = (r.text or "").encode(), got[r.doc_id]
        assert own.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if not any(c.isalpha() for c in r.text or ""):
            assert (own.lang_pred, own.score, own.languages) == ("und", 0, [])
            continue
        if len(text) > 3000:
            continue
        checked += 1
        grams = language.trigrams(np.frombuffer(text, np.uint8))
        parts = [table[grams[a : a + language.SEGMENT]].sum(axis=0).tolist() for a in range(0, len(text), language.SEGMENT)]
        alone = [sum(p[k] for p in parts) for k in range(m)]
        best, share = max(alone), [float(k == alone.index(max(alone))) for k in range(m)]
        full, _ = proportions(parts, range(m))
        if max(full) < 1 - 1e-3:
            order = sorted(range(m), key=lambda k: -full[k])
            for k in range(2, m + 1):
                found, seen = proportions(parts, order[:k])
                gain = seen - (k - 1) * language.PENALTY * math.log(len(parts) + 1)
                if gain > best:
                    best, share = gain, found
        top = share.index(max(share))
        assert own.lang_pred == model.languages[top]
        assert own.score == pytest.approx((share[top] * len(parts) + 1 / m) / (len(parts) + 1), abs=1e-4)
        assert sorted(own.languages) == sorted(model.languages[k] for k in range(m) if share[k] > 0)
    assert checked > 100


def test_six_languages_in_one_text():
    rng = random.Random(4)
    names = [f"l{k}" for k in range(6)]
    letters = ["abcd", "efgh", "ijkl", "mnop", "qrst", "uvwx"]
    text = {n: " ".join("".join(rng.choice(x) for _ in range(5)) for _ in range(400)).encode() for n, x in zip(names, letters)}
    counts = np.stack([np.bincount(language.trigrams(np.frombuffer(text[n], np.uint8)), minlength=language.BUCKETS) for n in names])
    share, _ = language.Model(names, counts.astype(float)).infer([b" ".join(text[n][:960] for n in names)])
    assert (share[0] > 0.1).all()


def test_suffix_dedup_survives_hashes_that_all_collide(monkeypatch):
    """The steps run one after another in this process, with a polynomial hash that says no more than a string's length."""
    import pyarrow as pa

    from tessera.llm import packed

    rng = random.Random(8)
    passage = "".join(rng.choice("abc ") for _ in range(260))
    docs = []
    for i in range(10):
        at = rng.randrange(120)
        docs.append((i, "".join(rng.choice("xyz ") for _ in range(rng.randrange(90))) + passage[at : at + rng.randrange(80, 260)] + rng.choice(["", "tail"])))
    docs += [(10, docs[3][1]), (11, "q" * 230)]
    monkeypatch.setattr(suffix_core, "_BYTE", np.ones(256, np.uint64))

    def met(parts, work):
        held = {}
        for batch in parts:
            for kind, bucket, payload in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(bucket, {}).setdefault(kind, []).append(payload)
        return [x for bucket, own in sorted(held.items()) for x in work(bucket, own)]

    def only(parts, kind):
        return [b.filter(pa.array([k == kind for k in b.column("kind").to_pylist()])) for b in parts]

    tables = [pa.RecordBatch.from_arrays([pa.array([i for i, _ in own]), pa.array([t for _, t in own])], names=["key", "text"]) for own in (docs[::2], docs[1::2])]
    scan = lambda step: [x for t in tables for x in packed.batches_of(step(iter([t]), 8))]
    found = met(scan(suffix_dedup._find), suffix_dedup._resolve_anchors(8))
    more = met(met(scan(suffix_dedup._pack_texts) + only(found, suffix_dedup.REP), suffix_dedup._fetch_contexts(8)), suffix_dedup._resolve_contexts(8))
    cut = met(scan(suffix_dedup._pack_texts) + only(found, suffix_dedup.FLAG) + more, suffix_dedup._cut(False))
    assert sorted(tuple(r.values()) for b in cut for r in b.to_pylist()) == repeated([(i, t.encode()) for i, t in docs])
