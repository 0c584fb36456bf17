"""Every operator against a plain version, on rows with nulls, empty and long texts, ties and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from helpers import AWKWARD, DOCS, awkward_documents, documents, stored, words
from pyspark.sql import functions as F

from tidecast.llm import langid, licenses, mixing, ordermh, packing, quotes, simhash, surrogates, topk, urlfilter
from tidecast.llm.common import components, stored as stored_rows
from tidecast.llm.queries import RULES, vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    return awkward_documents(spark, tmp_path_factory.mktemp("awkward"))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return stored(spark, tmp_path_factory.mktemp("empty"), [], DOCS)


# packing

def token_ids(text):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(vocabulary())
    model.encode_special_tokens = True
    return model.encode(text or "", add_special_tokens=False).ids + [packing.END]


def test_encoder_equals_whole_texts():
    odd = ["a  b", " a", "a ", "\n\n x  \n y", "tab\t x", " \x1c x", "it's  'll <|endoftext|> don't", "", "   ",
           "é　 　x", " \u200bx 1 2  3", "日本 語", words(1, 500), "one,two;3.4:x!y?z", "a.\nB\n\nC\r\nD ,e", "it's, 's,x ''s.", ",.;\n!a1b2",
           "x\0y\0 z", "tail ", "a,\u0301b", "é.É\nü ß?", "(a),\"b\"... c", "1,000.50\n2", "\n", ",", "Ⅷ.٣,x"]
    odd += ["".join(random.Random(i).choices("ab1é ,.\n'(s\r\t!", k=60)) for i in range(300)]
    encode = packing.encoder(vocabulary())
    for texts in (odd, *[[t] for t in odd], odd):
        assert [x.tolist() for x in encode(texts)] == [token_ids(t)[:-1] for t in texts]


def check_packing(rows, pieces):
    """Every id in exactly one piece; sequences gapless; only the last may be padded."""
    by_row = defaultdict(list)
    for p in pieces:
        by_row[p.row_id].append(p)
    texts = Counter((d, t) for d, t, *_ in rows)
    seen = Counter()
    for group in by_row.values():
        group.sort(key=lambda p: p.start)
        match = [(d, t) for d, t in texts if d == group[0].doc_id and all(
            zlib.crc32(np.array(token_ids(t)[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for p in group)
            and len(token_ids(t)) == group[0].doc_tokens]
        assert match and [p.start for p in group] == list(np.cumsum([0] + [p.length for p in group[:-1]]))
        assert sum(p.length for p in group) == group[0].doc_tokens
        seen[match[0]] += 1
    assert seen == texts
    padded = 0
    for s in {p.sequence_id for p in pieces}:
        inside = sorted((p for p in pieces if p.sequence_id == s), key=lambda p: p.offset)
        assert [p.offset for p in inside] == list(np.cumsum([0] + [p.length for p in inside[:-1]]))
        padded += sum(p.length for p in inside) != inside[0].tier
        assert sum(p.length for p in inside) <= inside[0].tier
    assert padded <= 1


def test_packing(awkward, empty):
    docs, rows = awkward
    for block in (1 << 20, 3000):
        check_packing(rows, packing.pack_documents(docs, vocabulary(), block_tokens=block).collect())
    assert packing.pack_documents(empty, vocabulary()).count() == 0


def test_step_groups_are_balanced():
    pieces = [(i, i, 0, np.zeros(n, "<u4"), n) for i, n in enumerate(np.random.default_rng(0).integers(1, 3000, 2000))]
    windows, rest = packing.pack(pieces)
    out = packing.Sequences(0, step_tokens=1 << 13)
    rows = out.add(windows) + out.end()
    cost, tokens = defaultdict(float), defaultdict(int)
    for r in rows:
        cost[r[8], r[9]] += r[3] ** 2
        tokens[r[8], r[9]] += r[3]
    for tier in packing.TIERS:
        full = [g for g in tokens if g[0] == tier and tokens[g] == 1 << 13]
        assert len(full) >= len([g for g in tokens if g[0] == tier]) - 1
    costs = [v for g, v in cost.items() if g[0] == 2048 and tokens[g] == 1 << 13]
    assert max(costs) < 1.5 * min(costs)


# license scan

def plain_containment(text, template):
    split = lambda t: re.findall(r"\w+", (t or "").lower())
    grams = lambda w: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    wanted = grams(split(template))
    return len(wanted & grams(split(text))) / len(wanted)


def test_license_scan(spark, tmp_path, empty):
    texts, at = {}, 0
    for name, notice in licenses.TEMPLATES.items():
        for before in (0, 3, 700, 20_000):
            texts[at] = f"{words(at, before)} {notice} {words(at + 1, 50)}"
            at += 1
        changed = notice.split()
        if len(changed) > 60:  # one word changed: five shingles lost
            changed[10] = "changed"
            texts[at] = f"{words(at, 100)} {' '.join(changed)} {words(at + 1, 100)}"
            at += 1
    docs = documents(spark, tmp_path, [(i, t, None, None) for i, t in texts.items()] + [(900 + i, t, None, None) for i, t in enumerate(AWKWARD)])
    got = defaultdict(dict)
    for r in licenses.scan_licenses(docs).collect():
        got[r.doc_id][r.license] = r.containment
        assert r.first_word <= r.last_word
    for i, text in texts.items():
        want = {n: c for n, t in licenses.TEMPLATES.items() if (c := plain_containment(text, t)) >= licenses.CONTAINMENT}
        assert got[i] == pytest.approx(want), i
    assert not any(i >= 900 for i in got)
    assert licenses.scan_licenses(empty).count() == 0


# url filter

def plain_verdict(url, rules):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[2]), m[3]) if m else ("", "")
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


URLS = [None, "", "no scheme", "http://", "http://a.NET/x", "https://Sub.Example.net/en/1?x=/y#z", "http://example.net/en", "http://example.net/de/",
        "http://xexample.com/de/1", "http://example.com/de/", "ftp://a.b.example.com/de/q", "http://org/fr/", "http://x.org/fr/a", "http://net", "http://net?/",
        "http://net/", "http://a.net:80/", "http://user@a.net/", "x://y://z.net/", "http://ÄB.NET/", "http://a.net/" + "p" * 10_000, "http://a.net/x", "http://.net/"]


def test_url_filter(spark, tmp_path):
    pages = stored(spark, tmp_path, [(i, u, "h", "r") for i, u in enumerate(URLS)] + [(None, "http://a.net/", "h", "r")], "page_id long, url string, host string, rule string")
    got = urlfilter.filter_urls(pages, urlfilter.build_rules(urlfilter.rules_table(spark, RULES))).collect()
    want = Counter((i, *plain_verdict(u, RULES)) for i, u in [*enumerate(URLS), (None, "http://a.net/")])
    assert Counter(map(tuple, got)) == want
    nothing = urlfilter.build_rules(spark.createDataFrame([], urlfilter.RULE_FIELDS))
    assert {r.verdict for r in urlfilter.filter_urls(pages, nothing).collect()} == {"allow"}
    assert urlfilter.filter_urls(pages.limit(0), nothing).count() == 0


def test_many_rules_in_several_files(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "SHARD_RULES", 100)
    rules = [(f"h{i}.org", f"/p{i % 7}", "block" if i % 2 else "allow") for i in range(950)]
    built = urlfilter.build_rules(urlfilter.rules_table(spark, rules))
    assert len(built.firsts) == 10
    assert built.find([h + p for h, p, _ in rules]) == [v for *_, v in rules]
    assert built.find(["h1.org/p", "", "h951.org/p6"]) == [None] * 3


def test_equal_digests_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "digest", lambda text: 7)
    folder = urlfilter.scratch_path(spark, "rules")
    kind, path = urlfilter._filesystem(folder)
    kind.create_dir(path, recursive=True)
    strings = [b"a.org/\nblock", b"b.org/\nallow"]
    urlfilter._write(f"{folder}/0.digests", np.array([7, 7], "<u8").tobytes())
    urlfilter._write(f"{folder}/0.offsets", np.cumsum([0, *map(len, strings)]).astype("<u8").tobytes())
    urlfilter._write(f"{folder}/0.strings", b"".join(strings))
    assert urlfilter.RuleList(folder, [0], [1]).find(["b.org/", "c.org/", "a.org/"]) == ["allow", None, "block"]


# order min-hash

def chained_hash(*parts):
    """Spark's xxhash64: every part is hashed with the hash of those before as its seed."""
    h = 42
    for x in parts:
        h = xxhash.xxh64_intdigest(x if isinstance(x, bytes) else x.encode(), h)
    return h - (1 << 64) if h >> 63 else h


def plain_order_minhash(text):
    """Fingerprint by lists and sorting: occurrence-numbered 3-mers, the two smallest hashes a bin, in text order."""
    low = (1 << 24) - 1
    tokens = re.findall(r"[^\x20\x09-\x0D]{1,8}", text)
    grams = [(chained_hash(*tokens[i:i + 3]) >> 24, i) for i in range(len(tokens) - 2)] or ([(chained_hash(" ".join(tokens)) >> 24, 0)] if tokens else [])
    seen, numbered = Counter(), []
    for gram, place in grams:  # places rise, so occurrences are numbered in the order of the text
        numbered.append((chained_hash(gram.to_bytes(8, "little", signed=True), seen[gram].to_bytes(4, "little")) & ~low | place))
        seen[gram] += 1
    bins = defaultdict(list)
    for x in sorted(numbered):
        if len(bins[x >> 58]) < 2:
            bins[x >> 58].append(x)
    out = ""
    for number in sorted(bins):
        hashes = [x >> 24 & (1 << 40) - 1 for x in sorted(bins[number], key=lambda x: (x & low, x >> 24 & (1 << 40) - 1))]
        tuple_hash = chained_hash(*[x.to_bytes(8, "little") for x in hashes])
        out += f"{(number + 32) << 32 | tuple_hash & 0xFFFFFFFF:010x}"
    return out


def test_order_minhash_equals_a_plain_one(awkward):
    docs, rows = awkward
    texts = {(d, len(t or "")): t or "" for d, t, *_ in rows}
    got = ordermh.order_minhash(docs).select("doc_id", "n_chars", "fingerprint").collect()
    assert len(got) == len(rows) and sum(len(r.fingerprint) > 600 for r in got) >= 1
    for r in got:
        assert r.fingerprint == plain_order_minhash(texts[r.doc_id, r.n_chars]), r.doc_id


def test_order_minhash(spark, awkward, empty, tmp_path):
    docs, rows = awkward
    got = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in ordermh.order_minhash(docs).collect()}
    ordered = sorted(((d, t or "") for d, t, *_ in rows), key=lambda x: (x[0] is not None, x))
    prints = defaultdict(set)
    for i, (d, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = got[d, len(text), hashlib.sha256(edited.encode()).hexdigest()]
        prints[text].add(r.fingerprint)
        prints[edited].add(r.edited_fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if following == text:
            assert r.near_next == 1
        if edited == text:
            assert r.near_edited == 1
    assert all(len(v) == 1 for v in prints.values())
    assert ordermh.order_minhash(empty).count() == 0


def test_order_minhash_over_parts(spark, tmp_path):
    ids = [3, 127, 128, 129, 5000, 600_000, 600_001, 70_000_000, 2 ** 40]
    docs = documents(spark, tmp_path, [(d, words(d, 40), None, None) for d in ids])
    got = {r.doc_id: r for r in ordermh.order_minhash(docs).collect()}
    for d, n in zip(ids, [*ids[1:], ids[0]]):
        text, half = words(d, 40), len(words(d, 40)) // 2
        assert got[d].edited_sha256 == hashlib.sha256((text[:len(text) - half] + words(n, 40)[:half]).encode()).hexdigest()


def test_order_minhash_follows_edits_and_order(spark, tmp_path):
    base = words(5, 600).split()
    few, many, turned = list(base), list(base), base[300:] + base[:300]
    few[100] = "changed"
    for i in range(0, 600, 6):
        many[i] = f"new{i}"
    blocks = [base[i:i + 12] for i in range(0, 600, 12)]
    shuffled = [w for b in blocks[::-1] for w in b]
    docs = documents(spark, tmp_path, [(0, " ".join(base), None, None)] + [
        (i, " ".join(t), None, None) for i, t in enumerate((few, many, turned, shuffled), 1)])
    prints = ordermh.with_fingerprint(docs.select("doc_id", "text"), "text", "f")
    first = prints.filter("doc_id = 0").select(F.col("f").alias("g"))
    near = dict(map(tuple, prints.crossJoin(first).select("doc_id", ordermh.likeness("f", "g")).collect()))
    assert near[0] == 1 and near[1] > 0.85 and near[1] > near[3] > near[4] and near[2] < 0.4


# near duplicates

def plain_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    ids, label = sorted(prints), {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if (prints[i] ^ prints[j]).bit_count() <= simhash.DISTANCE and label[j] > label[i]:
                    label[j], changed = label[i], True
    return label


def plain_classes(rows):
    """doc_id, fingerprint and component of every row; rows without doc_id link like others."""
    prints = [plain_fingerprint(t) for _, t in rows]
    label = plain_components(dict(enumerate(prints)))
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[label[i]].append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return [(d, prints[i], least[label[i]]) for i, (d, _) in enumerate(rows)]


def kept_ids(classes):
    """The ids of the rows that stay; components without any id are told apart by their smallest fingerprint."""
    label = plain_components({p: p for _, p, _ in classes})
    return Counter(dict((label[p], c) for _, p, c in classes).values())


def test_rows_without_id_connect_others(spark, tmp_path, monkeypatch):
    prints = {"a": 0, "b": 7, "c": 63, "d": 1 << 40 | 1023}
    rows = [(1, "a"), (None, "b"), (3, "c"), (4, "d"), (3, "c")]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs: stored(
        spark, tmp_path, [(d, (0, i), prints[t]) for i, (d, t) in enumerate(rows)], "doc_id long, _row struct<file: long, row: long>, fp long", "prints"))
    docs = documents(spark, tmp_path, [(d, t, None, None) for d, t in rows])
    assert sorted((r.component_id, r.doc_id or 0) for r in simhash.near_duplicates(docs).collect()) == [(1, 0), (1, 1), (1, 3), (1, 3), (4, 4)]


def test_near_duplicates(awkward, empty):
    docs, rows = awkward
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    want = plain_classes([(d, t) for d, t, *_ in rows])
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == Counter((d, f"{p:016x}", c) for d, p, c in want)
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == kept_ids(want)


@pytest.mark.parametrize("chunk", [4, 7, 1024])
def test_links_of_dense_and_random_fingerprints(spark, tmp_path, chunk):
    r = np.random.default_rng(chunk)
    base = [int(x) for x in r.integers(0, 1 << 63, 40, dtype=np.uint64) * 2 + 1]
    prints = set(base)
    for b in base[:4]:
        for _ in range(60):  # crowds around four fingerprints, in steps of up to three bits
            flips = r.choice(64, r.integers(1, 7), replace=False)
            prints.add(b ^ sum(1 << int(f) for f in flips))
    prints = {i: p for i, p in enumerate(sorted(prints))}
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    classes = stored(spark, tmp_path, [(signed(p), i) for i, p in prints.items()], "fp long, first long")
    roots = dict(map(tuple, components(simhash.near_links(classes, chunk)).collect()))
    groups, want = defaultdict(set), defaultdict(set)
    for i, label in plain_components(prints).items():
        groups[roots.get(signed(prints[i]), signed(prints[i]))].add(i)
        want[label].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_and_stars(spark, tmp_path):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (7001, 7000)]
    got = dict(map(tuple, components(stored(spark, tmp_path, edges, "u long, v long")).collect()))
    assert all(got[i] == 0 for i in range(1, 301)) and all(got[1000 + i] == 1000 for i in range(1, 200)) and got[7001] == 7000


# mixing

def plain_targets(sizes, passes=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight, target, rest, open_ = {s: 1 + i % 3 for i, s in enumerate(order)}, {}, sum(sizes.values()), set(sizes)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * rest / total > passes * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = passes * sizes[s]
            open_.discard(s)
        rest = sum(sizes.values()) - sum(target.values())
    return {**{s: weight[s] * rest / sum(weight[x] for x in open_) for s in open_}, **target}


def test_mixing(awkward, empty):
    docs, rows = awkward
    size = lambda t: len(WORD.findall(t or ""))
    sources = Counter()
    for _, t, _, s in rows:
        sources[s] += size(t)
    want = plain_targets(sources)
    got = mixing.taken_words(docs).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, size(t)) for d, t, *_ in rows)
    of = {}
    for d, _, _, s in rows:
        of[d] = s
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sources[of[r.doc_id]]
        assert r.target == pytest.approx(want[of[r.doc_id]])
        taken[of[r.doc_id]] += r.taken
    for s in sources:
        assert math.floor(want[s]) - 1 <= taken[s] <= want[s] + 1e-6
    path = tempfile.mkdtemp()
    docs.repartition(5).sortWithinPartitions("text").write.mode("overwrite").parquet(path)
    again = mixing.taken_words(docs.sparkSession.read.parquet(path).select("text", "source", "doc_id"))
    assert Counter((r.doc_id, r.taken) for r in again.collect()) == Counter((r.doc_id, r.taken) for r in got)
    order = mixing.mix(stored_rows(docs)).orderBy("position").collect()
    assert [r.finish for r in order] == sorted(r.finish for r in order)
    assert [r.position for r in order] == list(np.cumsum([0] + [r.words for r in order[:-1]]))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = Counter((r._row["file"], r._row["row"]) for r in order if 2 * r.words >= r.size)
    assert mixed.count() == sum(copies.values()) and max(copies.values()) <= 3
    assert {(r.doc_id, r.text) for r in mixed.collect()} <= {(d, t) for d, t, *_ in rows}
    assert mixing.taken_words(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_targets_fill_up_in_turn(spark, tmp_path):
    sizes = {"a": 5, "b": 1, "c": 400, "d": 30, "e": 0, None: 2, "ä": 90}
    table = stored(spark, tmp_path, [(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(table).collect()}
    assert got == pytest.approx(plain_targets(sizes))


# surrogates

def test_surrogates(spark, tmp_path, empty):
    texts = {
        1: "Write to Ann.Lee@Mail.example.com or ann.lee@mail.example.com, call +1 (743) 555-3824 or +1-743-555-3824.",
        2: "ann.lee@mail.example.com again; host 10.1.2.3, not 10.1.2.300 or 1.2.3.4.5; card 4785 3805 9239 1139 and 4785380592391139.",
        3: 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" and 123-45-6789',
        4: "Mr. John Smith met Mrs Anna SMITH; Mr Smith left. Herr Müller, г-н Иванов and г-жа Петрова stayed.",
        5: "Nothing personal: 12 of 345 at 3.14, 2024-01-05, a@b, v1.2.3",
        6: None, 7: "", 8: "x" * 200_000, 9: "a." * 60_000 + "@", 10: "call +1 (743) 555-3824 to +1 (743) 555-3825",
    }
    rows = [(i, t, None, None) for i, t in texts.items()] + [(1, texts[1], None, None)]
    docs = documents(spark, tmp_path, rows)
    out = surrogates.replace_entities(docs, "key", counted="found")
    assert out.columns == [*docs.columns, "found"]
    got = defaultdict(set)
    for r in out.collect():
        got[r.doc_id].add((r.text, r.found))
    assert all(len(v) == 1 for v in got.values()) and len(got) == len(texts)
    new = {i: next(iter(v))[0] for i, v in got.items()}
    for i in (5, 6, 7, 8, 9):
        assert new[i] == texts[i] and next(iter(got[i]))[1] == 0
    for gone in ("ann.lee", "Ann.Lee", "555-3824", "10.1.2.3,", "4785", "24be64", "123-45-6789", "John", "Smith", "SMITH", "Müller", "Иванов", "Петрова"):
        assert not any(gone in (t or "") for i, t in new.items() if i != 5), gone
    assert "10.1.2.300 or 1.2.3.4.5" in new[2]
    m = re.fullmatch(r"Write to (\S+) or (\S+), call \+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1-(\d{3})-(\d{3})-(\d{4})\.", new[1])
    assert m and m[1] == m[2] and m.groups()[2:5] == m.groups()[5:8]
    assert new[2].startswith(m[1] + " again")
    cards = re.search(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16})\.", new[2])
    assert cards[1].replace(" ", "") == cards[2]
    assert re.fullmatch(r'token = "[0-9a-f]{40}" and \d{3}-\d{2}-\d{4}', new[3])
    n = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs (\w+) (\w+); Mr (\w+) left\. Herr (\w+), г-н ([А-Яа-я]+) and г-жа ([А-Яа-я]+) stayed\.", new[4])
    assert n and n[2] == n[5] and n[4] == n[2].upper() and n[1].endswith("lin") and n[3].endswith("rina")
    phones = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}", new[10])
    assert len(set(phones)) == 2 and phones[0].replace("+1 ", "") in new[1]
    other = {r.doc_id: r.text for r in surrogates.replace_entities(docs, "other key").collect()}
    assert other[3] != new[3]
    assert surrogates.replace_entities(empty, "key").count() == 0


def test_surrogates_of_capitals_and_bank_codes(spark, tmp_path):
    key = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"
    ibans = ["GB29 NWBK 6016 1331 9268 19", "NL91 ABNA 0417 1643 00", "IE29 AIBK 9311 5212 3456 78", "MT84 MALT 0110 0012 345M TLCA ST00 1S",
             "GB29NWBK60161331926819", "NO93 8601 1117 947", "DE89 3704 0044 0532 0130 00", "FR14 2004 1010 0505 0001 3M02 606", "QQ12 ABCD 1234 5678 9012"]
    texts = [f'token = "{key}"', f'TOKEN = "{key.upper()}"', f'token = "{key[:20]}{key[20:].upper()}"', "ARTICLE AB12 THAT HAVE FOUR LETTERS IN CAPITALS",
             "BE68 5390 0754 7034 THIS WORD STAYS", *[f"IBAN {x}, TO BE PAID" for x in ibans], "1234567890" * 4]
    docs = documents(spark, tmp_path, [(i, t, None, None) for i, t in enumerate(texts)])
    new = {r.doc_id: r.text for r in surrogates.replace_entities(docs, "key").collect()}
    lower, upper, mixed = (re.fullmatch(r'(?:token|TOKEN) = "([0-9A-Fa-f]{40})"', new[i])[1] for i in range(3))
    assert lower != key and lower == lower.lower() == upper.lower() == mixed.lower() and upper == upper.upper()
    assert new[3] == texts[3] and re.fullmatch(r"BE\d\d \d{4} \d{4} \d{4} THIS WORD STAYS", new[4]) and new[4] != texts[4]
    for i, x in enumerate(ibans, 5):
        got = re.fullmatch("IBAN (.*), TO BE PAID", new[i])[1]
        kinds = lambda t: re.sub("[A-Z]", "A", re.sub("[0-9]", "0", t))
        assert got != x and got[:2] == x[:2] and kinds(got) == kinds(x), (x, got)
    assert new[9].split()[1].rstrip(",") == "".join(new[5].split()[1:7]).rstrip(",")
    assert re.fullmatch("[0-9a-f]{40}", new[14]) and new[14] != texts[14]


def luhn(digits):
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def test_surrogates_keep_people_numbers_and_check_digits(spark, tmp_path):
    """A plain reading of the new texts: one surrogate per entity, one entity per surrogate, valid check digits."""
    people = ["Mr. John Smith", "Dr. John Smith", "Mrs. Mary Smith", "Prof. Mary Jones", "Dr. Kim Lee", "Mr. Kim Park", "Mrs. Kim Park"]
    cards = ["4785 3805 9239 1139", "5500-0000-0000-0004", "3782 822463 10005"]
    ibans = ["GB29 NWBK 6016 1331 9268 19", "DE89 3704 0044 0532 0130 00", "FR14 2004 1010 0505 0001 3M02 606"]
    mails = [f"{c}@example.com" for c in "abcdefghijklmnopqrstuvwxyz"]
    phones = ["+1 (743) 555-3824", "743-555-3824", "(743) 555-3824", "+44 20 7946 0958", "743-555-3825"]
    texts = [f"{x} ." for x in [*people, *cards, *ibans, *mails, *phones]]
    docs = documents(spark, tmp_path, [(i, t, None, None) for i, t in enumerate(texts)])
    new = [r.text[:-2] for r in sorted(surrogates.replace_entities(docs, "k").collect(), key=lambda r: r.doc_id)]
    given, surname = {}, {}
    for old, got in zip(people, new):
        title, first, last = got.split(" ")
        assert title == old.split(" ")[0]
        assert given.setdefault(old.split(" ")[1], first) == first and surname.setdefault(old.split(" ")[2], last) == last
    assert len(set(given.values())) == 3 and len(set(surname.values())) == 4
    assert given["John"].endswith("lin") and given["Mary"].endswith("rina") and given["Kim"].endswith("mir")
    for got, old in zip(new[7:10], cards):
        assert got != old and luhn(re.sub(r"\D", "", got)) and re.sub(r"\d", "0", got) == re.sub(r"\d", "0", old)
    for got, old in zip(new[10:13], ibans):
        plain = got.replace(" ", "")
        assert got != old and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert len(set(new[13:39])) == 26 and not set(new[13:39]) & set(mails) and all("@" in m and m.endswith(".com") for m in new[13:39])
    digits = [re.sub(r"\D", "", x) for x in new[39:]]
    assert digits[0] == "1" + digits[1] and digits[1] == digits[2] and len({digits[1], digits[3], digits[4]}) == 3
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new[39])


def test_surrogates_stay_distinct(spark, tmp_path):
    """A format with few forms: 900 of 1,000,000 would meet by chance, and none may be an original."""
    entities = stored(spark, tmp_path, [("id", f"{i:03d}") for i in range(0, 900, 2)] + [("surname", f"n{i}") for i in range(700)], "kind string, entity string")
    got = surrogates.assign(entities, "k").collect()
    assert len(got) == 1150 and len({(r.kind, r.surrogate) for r in got}) == 1150
    originals = {(r.kind, r.entity) for r in got}
    assert not originals & {(r.kind, r.surrogate) for r in got}


# exact search

def test_top_k(spark, tmp_path):
    r = np.random.default_rng(1)
    vectors = [[float(x) for x in v] for v in r.normal(0, 0.3, (120, 9))]
    vectors[7], vectors[8] = vectors[0], vectors[0]
    vectors[20][3], vectors[21][0], vectors[22] = math.nan, math.inf, None
    vectors[23] = [*vectors[23][:4], None]
    vectors[24], vectors[25], vectors[100] = [], vectors[25][:5], [0.0] * 9
    rows = [(i, v, 1, 2) for i, v in enumerate(vectors)] + [(50, vectors[50], 1, 2), (None, vectors[1], 1, 2)]
    table = stored(spark, tmp_path, rows, "vec_id long, embedding array<float>, score int, rank int", partitions=3)
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = Counter()
    for n, (q, a) in enumerate(good):
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(good) if m != n)[:5]
            want.update((q, k, i, -s) for k, (s, i) in enumerate(scored, 1))
    for sizes in ((8192, 1024), (16, 2)):
        got = topk.top_k(table, F.col("vec_id") % 50 == 0, block_rows=sizes[0], block_queries=sizes[1])
        assert Counter(map(tuple, got.collect())) == want
    two = table.filter("vec_id < 2")
    path = str(tmp_path / "two")
    two.write.parquet(path)
    assert topk.top_k(spark.read.parquet(path), F.col("vec_id") % 50 == 0).count() == 1
    assert topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def plain_top_k(rows):
    """query_id, rank, vec_id, score of rows (id, vector) without nulls, in whole numbers of any length."""
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    want = Counter()
    for n, (q, a) in enumerate(whole):
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(whole) if m != n)[:5]
            want.update((q, k, i, -s) for k, (s, i) in enumerate(scored, 1))
    return want


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_top_k_blocks_meet_over_many_partitions(spark, tmp_path, adaptive):
    """Both sides of a pair of blocks reach the same task although no partitions are joined into one."""
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(r.normal(0, 0.3, (300, 6)))]
    table = stored(spark, tmp_path, rows, "vec_id long, embedding array<float>", partitions=3)
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.enabled": adaptive, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for sizes in ((8192, 1024), (40, 2)):
            got = topk.top_k(table, F.col("vec_id") % 50 == 0, block_rows=sizes[0], block_queries=sizes[1])
            assert Counter(map(tuple, got.collect())) == plain_top_k(rows)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_top_k_of_huge_components(spark, tmp_path):
    """Products and sums beyond 64 bits neither wrap nor stop at 2**63; a score that fits no long is an error."""
    rows = [(0, [1.0, 1.0]), (1, [-1e30, 0.0]), (2, [1e30, -1e30]), (3, [2.0**46, 3 / 256]), (4, [-2.0**55, -1.0]),
            (5, [-1.0, 0.0]), (6, [0.0, -2.0]), (7, [-3.0, 0.5]), (50, [-1e30, -2.0])]
    schema = "vec_id long, embedding array<float>"
    table = stored(spark, tmp_path, rows[:-1], schema)
    for blocks in (8192, 2):
        got = topk.top_k(table, F.col("vec_id") % 50 == 0, block_rows=blocks).collect()
        assert Counter(map(tuple, got)) == plain_top_k(rows[:-1])
        assert {r.vec_id: r.score for r in got}[3] == 2**62 + 768
    path = str(tmp_path / "huge")
    spark.createDataFrame(rows, schema).write.parquet(path)
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(spark.read.parquet(path), F.col("vec_id") % 50 == 0).collect()


# language

def plain_bits(text, counts, order=3):
    """Code length in bits under {context: {byte: count}} for contexts of up to three bytes."""
    data, total = b"\0" * order + text.encode(), 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = counts.get((k, data[i - k:i]), {})
            n, d = sum(seen.values()), len(seen)
            if data[i] in seen:
                total -= math.log2(seen[data[i]] / (n + d))
                break
            if n:
                total -= math.log2(d / (n + d))
        else:
            total += 8
    return total


def test_code_lengths_equal_a_plain_coder():
    learned = {"aa": ["abra cadabra", "abba"], "zz": ["zebra zoo", "öäü zz"]}
    rows, plain = [], {}
    for lang, texts in learned.items():
        plain[lang] = defaultdict(Counter)
        for t in texts:
            data = b"\0\0\0" + t.encode()
            rows += [(lang, int(g), 1) for g in langid.grams(data)]
            for i in range(3, len(data)):
                for k in range(4):
                    plain[lang][k, data[i - k:i]][data[i]] += 1
    merged = Counter()
    for lang, g, n in rows:
        merged[lang, g] += n
    model = langid.build_model([(*k, n) for k, n in merged.items()])
    texts = ["abracadabra", "zoo", "quite unlike öl", "a", "zebra cad" * 50]
    want = [[plain_bits(t, plain[lang]) for lang in model.languages] for t in texts]
    assert np.allclose(langid.code_lengths(texts, model), want, rtol=1e-4)
    slices = langid.BYTES
    try:
        langid.BYTES = 7
        assert np.allclose(langid.code_lengths(texts, model), want, rtol=1e-4)
    finally:
        langid.BYTES = slices


def test_language(spark, awkward, empty, tmp_path):
    docs, rows = awkward
    model = langid.learn(docs)
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows)
    text_of = {d: t for d, t, *_ in rows}
    for r in got:
        text = text_of[r.doc_id]
        assert (r.lang_pred == "und") == (not text or not any(c.isalpha() for c in text))
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    kept = langid.identified(docs, model)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.lang_pred != "und")
    assert langid.learn(empty) is None and langid.predict(empty, None).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = langid.predict(docs, langid.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.95


# quotation links

def test_reply_order(spark, tmp_path):
    rows = [
        (1, 0, "user", "Shall we meet?\n\nI suggest Monday at noon."),
        (1, 1, "user", "Another topic entirely"),
        (1, 2, "assistant", "On Friday Ann wrote:\n> I suggest   MONDAY at noon.\n\nMonday is fine."),
        (1, 3, "user", "> > Shall we meet?\n> Monday is fine.\nGreat, see you"),
        (1, 4, "user", "> never said\nWhat?"),
        (1, 5, "user", ">> Monday is fine.\n>>> I suggest Monday at noon.\n> Great, see you\nBye\n\n"),
        (1, 6, "user", ">Another topic entirely"),
        (2, 0, "user", "> Shall we meet?\nnot in this conversation"),
        (2, 1, "user", None), (2, 2, "user", ""), (2, 3, "user", "5 > 3 is true"), (2, 3, "user", "5 > 3 is true"),
        (None, 1, "user", "> x\ny"), (3, None, "user", "> x\ny"),
    ]
    full = [(*r, "p", "q") for r in rows]
    table = stored(spark, tmp_path, full, "conv_id long, turn long, role string, text string, position string, thread string")
    got = quotes.reply_ordered(table).collect()
    assert len(got) == len(rows)
    one = {r.turn: r for r in got if r.conv_id == 1}
    assert {t: r.reply_to for t, r in one.items()} == {0: None, 1: None, 2: 0, 3: 2, 4: None, 5: 3, 6: 1}
    assert {t: (r.thread, r.depth) for t, r in one.items()} == {0: (0, 0), 1: (1, 0), 2: (0, 1), 3: (0, 2), 4: (4, 0), 5: (0, 3), 6: (1, 1)}
    assert [r.turn for r in sorted(one.values(), key=lambda r: r.position)] == [0, 2, 3, 5, 1, 6, 4]
    assert one[2].text == "Monday is fine." and one[3].text == "Great, see you" and one[5].text == "Bye" and one[6].text == ""
    assert [(q.level, q.source) for q in one[5].quoted] == [(1, 3), (2, 2), (3, 0)]
    two = sorted((r for r in got if r.conv_id == 2), key=lambda r: r.position)
    assert [r.position for r in two] == [0, 1, 2, 3, 4] and [r.turn for r in two] == [0, 1, 2, 3, 3]
    assert [r.text for r in two] == ["not in this conversation", "", "", "5 > 3 is true", "5 > 3 is true"]
    assert quotes.reply_ordered(table.limit(0)).count() == 0


def test_several_sources_at_one_level(spark, tmp_path):
    rows = [(1, 0, "user", "Shall we meet?\n\nI suggest Monday at noon."), (1, 1, "user", "Who brings the cake?"), (1, 2, "user", "Where is it?\nAnd when?"),
            (1, 3, "user", "> I suggest Monday at noon.\nFine.\n> Who brings the cake?\nI do.\n> And when?\nNo idea"),
            (1, 4, "user", "> Who brings the cake?\nNot me\n> Who brings the cake?\nas I said\n> > Where is it?\n> Not me\n>> Shall we meet?\n?"),
            (2, 0, "user", "first"), (2, 1, "user", "second"), (2, 2, "user", "> first\na"), (2, 2, "user", "> second\nb")]
    got = quotes.reply_ordered(stored(spark, tmp_path, rows, "conv_id long, turn long, role string, text string")).collect()
    links = {(r.conv_id, r.turn): ([(q.level, q.source) for q in r.quoted or []], r.reply_to) for r in got}
    assert len(got) == len(rows)
    assert links[1, 3] == ([(1, 0), (1, 1), (1, 2)], 2)  # each block is found as a whole, so the latest message counts
    assert links[1, 4] == ([(1, 1), (2, 0), (2, 2)], 1)
    assert links[2, 2] == ([(1, 0), (1, 1)], 1)
    direct = quotes.quotation_links(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r.conv_id, r.turn, r.level, r.source) for r in direct} == {(*key, *q) for key, (found, _) in links.items() for q in found}


def test_long_chain_of_replies(spark, tmp_path):
    rows = [(1, i, "user", (f"> line number {i - 1}\n" if i else "") + f"line number {i}") for i in range(70)]
    got = quotes.reply_ordered(stored(spark, tmp_path, rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r.turn: (r.thread, r.depth, r.position) for r in got} == {i: (0, i, i) for i in range(70)}


# rows keep their identity

@pytest.fixture
def changing_splits(spark):
    """Calls ``change`` between the passes over a table, as when executors come and go."""
    names = ("spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism", "spark.sql.files.maxPartitionBytes")
    before = {n: spark.conf.get(n, None) for n in names}
    turn = [0]

    def change():
        turn[0] += 1
        spark.conf.set(names[0], ["4m", "1", "100k"][turn[0] % 3])
        spark.conf.set(names[1], [8, 1, 3][turn[0] % 3])
        spark.conf.set(names[2], ["128m", "700", "20k"][turn[0] % 3])
    yield change
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_rows_keep_their_identity(spark, tmp_path, monkeypatch, changing_splits):
    from tidecast import session

    texts = [f"{words(i, 40)} write to user{i}@example.com" for i in range(80)]
    rows = [(i % 60 if i % 7 else None, t, "en", f"s{i % 3}") for i, t in enumerate(texts)]
    path = str(tmp_path / "many")
    spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(8).write.parquet(path)
    docs = spark.read.parquet(path)
    calm = {"pii": Counter(surrogates.replace_entities(docs, "key").collect()), "dedup": Counter(simhash.without_near_duplicates(docs).collect()),
            "mix": Counter(mixing.mixed_documents(docs).collect()), "taken": Counter(mixing.taken_words(docs).collect())}
    write = session.write_scratch

    def writing(df, name="table"):
        changing_splits()
        return write(df, name)

    for module in (surrogates, simhash, mixing):
        monkeypatch.setattr(module, "write_scratch", writing)
    out = Counter(surrogates.replace_entities(docs, "key").collect())
    assert out == calm["pii"] and not any(re.search(r"user\d+@example", r.text) for r in out)
    assert Counter(simhash.without_near_duplicates(docs).collect()) == calm["dedup"] and sum(calm["dedup"].values()) == 80
    assert Counter(mixing.mixed_documents(docs).collect()) == calm["mix"] and Counter(mixing.taken_words(docs).collect()) == calm["taken"]
