"""Phrase mining, the prefix trie and k-d shards against plain versions, on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from helpers import DOCS, awkward_documents, documents, stored, words

from tidecast.llm import kdshards, phrases, prefixtrie


# phrases

def plain_phrases(rows, best, least):
    seen, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                seen[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in seen.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {p[i:i + m] for p, a in frequent.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= 80 * f[p[i:i + m]]}
        scored = []
        for p, a in frequent.items():
            if p not in inside:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(scored)[:best], 1)]
    return out


def phrase_rows():
    r = random.Random(1)
    some = ["The", "cat", "sat", "on", "mat", "über", "ÜBER", "x y", "a\x1cb", "\U0001f600"]
    texts = [" ".join(r.choices(some, weights=[9, 5, 4, 3, 3, 2, 1, 1, 1, 1], k=r.randrange(1, 60))) for _ in range(150)]
    texts += ["new york city hall\tnew york  city hall. New York, city: hall"] * 40 + ["of of of of of of"] * 10 + ["pass\x0bage;pass\x0cage\rend\nend"] * 35
    texts += [None, "", "  \t ", ".,;:!?", "one", "longword " * 5000]
    langs = ["en", "en", "en", None, "de", "und"]
    return [(i, t, langs[i % 6], "s") for i, t in enumerate(texts)] + [(3, texts[3], None, "s")] * 2 + [(None, texts[5], "en", None)]


@pytest.mark.parametrize(("shard", "hashes", "best"), [(1 << 21, 1 << 22, 2000), (40, 50, 7)])
def test_collocations(spark, tmp_path, monkeypatch, shard, hashes, best):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard)
    monkeypatch.setattr(phrases, "SLICE_HASHES", hashes)
    rows = phrase_rows()
    got = phrases.collocations(documents(spark, tmp_path, rows), best=best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    want = plain_phrases([(g, t) for _, t, g, _ in rows], best, phrases.LEAST)
    assert len(want) > 2 * 7 and sorted(map(tuple, got)) == sorted(want)


def test_no_collocations(spark, tmp_path):
    assert phrases.collocations(stored(spark, tmp_path, [], DOCS)).count() == 0
    docs, _ = awkward_documents(spark, tmp_path, "awkward")
    assert phrases.collocations(docs.filter("text IS NULL OR text = ''")).count() == 0


def test_intervals_are_all_phrases():
    ids = np.array([0, *random.Random(3).choices([0, 1, 2, 3], weights=[1, 5, 3, 3], k=500)])
    levels = phrases.intervals(phrases.bwt_of(ids), 4)
    texts = [(s,) for s in levels[0].first]
    for m, level in enumerate(levels, 1):
        if m > 1:
            shorter, texts = texts, [(s, *texts[r]) for s, r in zip(level.first, level.rest)]
            assert all(t[:-1] == shorter[b] for t, b in zip(texts, level.begun))  # extension to the right
        want = Counter(tuple(ids[i:i + m]) for i in range(len(ids) - m + 1) if (ids[i:i + m] > 0).all())
        assert dict(zip(texts, level.count)) == want


def test_tasks_are_small_beside_the_heap(monkeypatch):
    """What a task of each step holds at most in Python, carried on to a full shard or slice."""
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 0))
    monkeypatch.setattr(phrases, "BATCH", 1 << 12, raising=False)
    r, n, peaks = random.Random(7), 1 << 16, {}
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(r.choices(words, weights=[1 / (i + 9) for i in range(3000)], k=512)) for _ in range(n // 512)]

    def step(name, run, rows, full=phrases.SHARD_WORDS):
        tracemalloc.start()
        out = run()
        peaks[name] = round(tracemalloc.get_traced_memory()[1] / rows * full / 1e6)
        tracemalloc.stop()
        return out

    docs = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": pa.array([t.encode() for t in texts], pa.binary())})
    index, = step("index", lambda: list(phrases._shard_rows(iter([docs]))), n)
    sliced = step("hashes", lambda: pa.Table.from_batches(phrases._hash_slices(2)(iter([index]))), n)
    row, = index.to_pylist()
    row["bits"] = []
    for p in range(2):
        group = sliced.filter(pc.equal(sliced["slice"], p))
        hashes = sum(map(len, group["counts"].to_pylist()))
        row["bits"] += step("bits", lambda group=group: phrases._frequent_bits(group), hashes, phrases.SLICE_HASHES).to_pylist()
    found = step("counts", lambda: pa.Table.from_batches(phrases._phrase_counts(2)(iter([pa.RecordBatch.from_pylist([row])]))), n)
    want = Counter(" ".join(w[i:i + m]).encode() for w in map(str.split, texts) for m in range(1, 5) for i in range(len(w) - m + 1))
    got = {x["phrase"]: x["a"] for x in found.to_pylist() if x["a"] >= phrases.LEAST}
    assert got == {p: a for p, a in want.items() if a >= phrases.LEAST} and any(b" " in p for p in got)
    assert max(peaks.values()) < 190, peaks


# prefix trie

def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    original = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = original.get(c - c % 100, [])[:h] + own[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * (len(node[-1][1]) if node else 0)
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(
        ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def conversation_rows():
    r = random.Random(2)
    rows = []
    for c in range(400):
        for t in range(r.randrange(1, 9)):
            rows.append((c * 3, t, r.choice(["user", "assistant"]), "ä" * r.randrange(3) if t < 4 else words(c % 5 + t, 5)))
    rows += [(2000 + i, t, "user", f"hot {t}") for i in range(150) for t in range(8)]  # copies of one conversation
    rows += [(5000, t, "user", "deep") for t in range(600)] + [(5001, t, "user", "deep") for t in range(500)]
    rows += [(7000, None, None, None), (7000, 0, "", ""), (7000, 0, "", ""), (7001, 1, "a", "b:c"), (7002, 1, "a:b", "c"), (None, 0, "user", "nobody's"),
             (7003, 0, "user", "x" * 100_000), (8101, 0, "user", "own only")]
    return rows


@pytest.mark.parametrize(("nodes", "piece"), [(1 << 19, 1 << 16), (30, 40)])
def test_prefix_trie(spark, tmp_path, monkeypatch, nodes, piece):
    monkeypatch.setattr(prefixtrie, "SHARD_NODES", nodes)
    monkeypatch.setattr(prefixtrie, "PIECE", piece)
    rows = conversation_rows()
    table = stored(spark, tmp_path, [(*r, -1, "p") for r in rows], "conv_id long, turn long, role string, text string, depth long, path string", partitions=4)
    got = prefixtrie.prefix_trie(table).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert Counter(map(tuple, got.collect())) == plain_trie(rows)
    assert prefixtrie.prefix_trie(table.limit(0)).count() == 0


def test_findclose():
    r = random.Random(4)
    for size in (1, 2, 50, 3000):
        bits, depth = [1], 1
        while len(bits) < size:
            if depth > 1 and r.random() < 0.5:
                bits.append(0)
                depth -= 1
            else:
                bits.append(1)
                depth += 1
        bits += [0] * depth
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(bits)
        assert prefixtrie.Parentheses(np.array(bits, np.int8)).findclose(opens, 100).tolist() == [want[i] for i in opens]
    deep = np.repeat([1, 0], 5000).astype(np.int8)
    assert prefixtrie.Parentheses(deep).findclose(np.arange(5000)).tolist() == list(range(9999, 4999, -1))


# shards

def plain_shards(rows, shards):
    """The same tree by sorting; of each row the coordinates are source, lang, doc_id and n_chars."""
    def hashed(s):
        return None if s is None else xxhash.xxh64_intdigest(s.encode(), 42) >> 2

    points = []
    for i, (d, t, g, s) in enumerate(rows):
        size, text = len((t or "").encode()) + 8, 42 >> 2 if t is None else xxhash.xxh64_intdigest(t.encode(), 42) >> 2
        doc = 42 >> 2 if d is None else xxhash.xxh64_intdigest(int(d).to_bytes(8, "little", signed=True), 42) >> 2
        points.append((size, (hashed(s), hashed(g), d, None if t is None else len(t)), text, doc, i))
    whole, leaf = [0] * 4, {}

    def span(some, axis):
        known = [p[1][axis] for p in some if p[1][axis] is not None]
        return max(known) - min(known) if known else 0

    def place(some, first, quota):
        if quota == 1 or not some:
            leaf.update({p[4]: first for p in some})
            return
        wide = [span(some, a) / w if w else 0.0 for a, w in enumerate(whole)]
        axis = wide.index(max(wide))
        some = sorted(some, key=lambda p: (p[1][axis] is not None, p[1][axis] or 0, p[2], p[3]))
        left = quota // 2
        wanted, cut = sum(p[0] for p in some) * left // quota, 0
        while wanted > 0 and some[cut][0] < wanted:
            wanted -= some[cut][0]
            cut += 1
        cut += wanted > 0 and 2 * wanted >= some[cut][0]
        place(some[:cut], first, left)
        place(some[cut:], first + left, quota - left)

    whole = [span(points, a) for a in range(4)]
    place(points, 0, shards)
    return [leaf[i] for i in range(len(rows))]


@pytest.mark.parametrize(("cells", "shards"), [(1 << 16, 24), (4, 7)])
def test_kd_shards(spark, tmp_path, monkeypatch, cells, shards):
    monkeypatch.setattr(kdshards, "CELLS", cells)
    r = random.Random(6)
    rows = [(r.choice([i, -i, i << 50]), words(i, r.randrange(1, 200)), r.choice(["en", "en", "de", None]), r.choice(["hot", "hot", f"s{i % 9}", None])) for i in range(300)]
    rows += [(1000 + i, "a copy that many share " * 5, "en", "hot") for i in range(200)] + [(5000, words(77, 9000), "fr", "s1"), (6000, None, None, None), (6001, "", "en", "s1")]
    table = documents(spark, tmp_path, rows)
    got = kdshards.kd_shards(table, shards).collect()
    key = lambda d, size, crc, shard: (d, size, crc, shard)
    want = Counter(key(d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), s) for (d, t, *_), s in zip(rows, plain_shards(rows, shards)))
    assert Counter(key(x.doc_id, x.size, x.text_crc32, x.shard) for x in got) == want
    slots = defaultdict(list)
    for x in got:
        slots[x.shard].append(x.slot)
        assert x.law == "bytes" and x.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_equal_and_few_rows(spark, tmp_path):
    table = documents(spark, tmp_path, [(None, "the same", "en", "s")] * 240)
    assert set(Counter(r.shard for r in kdshards.kd_shards(table).collect()).values()) == {10}
    few = documents(spark, tmp_path, [(1, "a", "en", "s"), (2, None, None, None)], "few")
    assert sorted((r.doc_id, r.slot) for r in kdshards.kd_shards(few).collect()) == [(1, 0), (2, 0)]
    assert kdshards.kd_shards(stored(spark, tmp_path, [], DOCS, "none")).count() == 0
    bare = table.select("doc_id", "text")
    assert len({r.shard for r in kdshards.kd_shards(bare).collect()}) == 24
