"""Merkle manifest, SimHash trie join and source divergence: brute force on small tables, and the edge cases of their docstrings."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from leadloom.llm import divergence, manifest, queries, simhash
from leadloom.llm.shared import written

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, fingerprint string, value int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, and columns with clashing names."""
    texts = {1: None, 2: "", 3: " \n\t ", 4: "one", 5: "Aa bb Cc dd", 6: "aa bb cc dd", 7: "aa bb cc dd ee", 8: "Orre " * 60_000,
             9: "x" * 5000, 10: "é̈ 日本語 🎉\x00", 11: "a\n\n\nb\n", 12: "one two", None: "aa bb cc dd"}
    rows = [(k, t, [None, "", "en"][i % 3], [None, "s", "", "t"][i % 4], i or None, "clash", "clash", 3) for i, (k, t) in enumerate(texts.items())]
    return spark.createDataFrame(rows + [rows[4]], DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def op_query(monkeypatch, name, docs, spark):
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    return queries.QUERIES[name](spark, "")


# --- Merkle manifest ----------------------------------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """Sorted rows of op11 by plain loops."""
    def leaf(r, text):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])

    def climb(nodes):
        levels = [nodes]
        while len(nodes) > 1:
            nodes = [sha(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
            levels.append(nodes)
        return levels

    def path(levels, at):
        out = []
        for level in levels[:-1]:
            run = level[at // 8 * 8: at // 8 * 8 + 8]
            out.append((run[:at % 8], run[at % 8 + 1:]))
            at //= 8
        return out

    trees = defaultdict(list)
    for r in rows:
        trees[(r["lang"] is not None, (r["lang"] or "").encode())].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    climbed = {t: climb([x[2] for x in sorted(found, key=lambda x: x[:3])]) for t, found in trees.items()}
    order = sorted(climbed)
    top = climb([climbed[t][-1][0] for t in order])
    out = []
    for k, t in enumerate(order):
        for at, (has_id, doc_id, own, r) in enumerate(sorted(trees[t], key=lambda x: x[:3])):
            way = path(climbed[t], at) + path(top, k)
            acc, text = own, r["text"]
            if has_id and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                acc = leaf(r, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
            for left, right in way:
                acc = sha(*left, acc, *right)
            out.append((r["doc_id"], own, climbed[t][-1][0], top[-1][0], sha(*[d for left, right in way for d in left + right]), acc, acc == top[-1][0]))
    return sorted(out, key=str)


def test_manifest_equals_plain_loops(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op11_manifest(spark, sf).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_manifest(docs.collect())
    assert {r["verified"] for r in got} == {True, False}


def test_manifest_of_odd_rows(monkeypatch, spark, odd, empty):
    got = op_query(monkeypatch, "op11_manifest", odd, spark).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_manifest(odd.collect())
    assert op_query(monkeypatch, "op11_manifest", empty, spark).collect() == []
    lone = odd.where("doc_id = 7")
    row = op_query(monkeypatch, "op11_manifest", lone, spark).first()
    assert row["leaf"] == row["root"] == row["subroot"] and row["proof_sha256"] == sha()


@pytest.mark.parametrize("n", [8, 9, 64, 65, 513])
def test_manifest_heights(spark, n):
    """Full and ragged runs, many trees in the top tree, and one changed leaf seen from its own proof only."""
    rows = written(spark.range(n).select("id", F.when(F.col("id") % 11 > 0, (F.col("id") % 11).cast("string")).alias("t"), manifest.digest_of("id").alias("d")))
    store = manifest.write_manifest(rows, tree="t", key="id", digest="d")
    found = manifest.proofs(store).withColumn("root", manifest.fold(F.col("digest"), F.col("path"))).collect()
    assert len(found) == n and {r["root"] for r in found} == {store.root}
    other = manifest.proofs(store).where("id = 3").select(manifest.fold(F.lit(sha("changed")), F.col("path")).alias("root")).first()
    assert other["root"] != store.root
    assert spark.read.parquet(f"{store.path}/trees/level=0").count() == n


# --- SimHash ------------------------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=2):
    """Least id reachable, of {id: fingerprint}."""
    ids, values = list(prints), np.array(list(prints.values()), dtype=np.uint64)
    label = {}
    for start in sorted(ids):
        if start in label:
            continue
        todo, label[start] = [start], start
        while todo:
            for k in np.flatnonzero(np.bitwise_count(values ^ np.uint64(prints[todo.pop()])) <= bits).tolist():
                if ids[k] not in label:
                    label[ids[k]] = start
                    todo.append(ids[k])
    return label


def test_simhash_equals_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows}
    label = plain_components(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op12_simhash(spark, sf).collect()}
    assert got == {k: (f"{prints[k]:016x}", label[k]) for k in prints}
    assert any(label[k] != k for k in label)


def test_simhash_of_odd_rows(monkeypatch, spark, odd, empty):
    got = op_query(monkeypatch, "op12_simhash", odd, spark).collect()
    assert len(got) == odd.count()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in odd.collect()}
    label = plain_components({k: v for k, v in prints.items() if k is not None})
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {(k, f"{v:016x}", label.get(k)) for k, v in prints.items()}
    assert label[1] == label[2] == label[3] == 1 and label[6] == 5
    assert op_query(monkeypatch, "op12_simhash", empty, spark).collect() == []


@pytest.mark.parametrize("node_rows", [8, 100, 4096])
def test_trie_join_links_all_pairs(spark, node_rows):
    """Random values, balls of near values, values that share long prefixes: components equal those of all pairs."""
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(1500)} | {0, (1 << 64) - 1}
    for base in [rng.getrandbits(64) for _ in range(20)]:
        values |= {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(40)}
    values |= {(0xABCDEF << 40) ^ (1 << rng.randrange(40)) ^ (rng.getrandbits(14)) for _ in range(600)}
    prints = {v: v for v in values}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    classes = written(spark.createDataFrame(signed, "fingerprint long").repartition(3), "classes")
    edges = {(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.trie_join(classes, node_rows=node_rows).collect()}
    assert all((a ^ b).bit_count() <= 2 and a != b for a, b in edges)
    parent = {v: v for v in values}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    assert {v: top(v) for v in values} == plain_components(prints)


def test_subtries_are_compared_exactly():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 12, 300, dtype=np.uint64) << np.uint64(20))
    b = np.unique(rng.integers(0, 1 << 12, 300, dtype=np.uint64) << np.uint64(20))
    for x, y, same in ((a, b, False), (a, a, True)):
        got = [tuple(p) for some in simhash.links(x, y, same, 0, 0, 2) for p in some.tolist()]
        want = [(p, q) for i, p in enumerate(x.tolist()) for j, q in enumerate(y.tolist()) if (p ^ q).bit_count() <= 2 and (not same or i < j)]
        assert sorted(got) == sorted(want)


def test_bits_are_counted_over_many_shingles():
    values = np.random.default_rng(1).integers(0, 2**63, 1000, dtype=np.uint64)
    assert simhash._set_bits(values).tolist() == [int(((values >> np.uint64(k)) & np.uint64(1)).sum()) for k in range(64)]
    assert simhash.fingerprint(b"a b c d " * 40_000) == plain_fingerprint("a b c d " * 40_000)


# --- source divergence --------------------------------------------------------------------------------------------------

def plain_audit(rows, top=200):
    """Rows of op13 by plain loops over all terms of all groups."""
    counts, in_docs, out = defaultdict(Counter), defaultdict(Counter), []
    for r in rows:
        lang, source = r["lang"] or "", r["source"] or ""
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"] or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", folded)
        counts[lang, source].update(terms)
        in_docs[lang].update(set(terms))
    for lang in {k[0] for k in counts}:
        kept = [t for t, n in in_docs[lang].items() if n >= 3]
        groups = {s: c for (part, s), c in counts.items() if part == lang}
        whole = {t: sum(c[t] for c in groups.values()) for t in kept}

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s, c in groups.items():
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


def test_divergence_equals_plain_loops(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert sorted(map(tuple, queries.op13_divergence(spark, sf).collect())) == plain_audit(rows)


def test_divergence_of_odd_rows(monkeypatch, spark, odd, empty):
    got = op_query(monkeypatch, "op13_divergence", odd, spark)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain_audit(odd.collect())
    assert op_query(monkeypatch, "op13_divergence", empty, spark).collect() == []


@pytest.mark.parametrize("heavy", [1, 3, 100])
@pytest.mark.parametrize("tile_terms, tile_groups", [(5, 4), (2048, 256)])
def test_tiles_and_postings_add_up(spark, heavy, tile_terms, tile_groups):
    """Any split into heavy and rare terms, and any tiles, give the plain sums; some groups are empty, counts are very uneven."""
    rng = random.Random(9)
    rows = []
    for k in range(400):
        words = [f"w{chr(97 + min(25, int(rng.expovariate(0.2))))}{rng.choice('ab')}" for _ in range(rng.randrange(12))] + ["the"] * (k % 40)
        rows.append((k, " ".join(w.translate({48 + i: None for i in range(10)}) for w in words) if k % 9 else None, rng.choice(["x", "y", None]), f"s{k % 11 or k % 2}", None, "", "", 0))
    docs = spark.createDataFrame(rows, DOCS)
    entries, groups = divergence.measured(written(divergence.term_counts(docs), "counts"))
    got = divergence.pair_divergence(written(entries, "shares"), groups, heavy, tile_terms, tile_groups).collect()
    want = [(lang, s, item, value) for lang, s, part, item, value, _ in plain_audit(docs.collect()) if part == "pair"]
    assert sorted(map(tuple, got)) == want


def test_long_texts_are_counted_in_pieces():
    text = ("Été word\n" * 300_000).encode()
    parts = list(divergence.pieces(text))
    assert len(parts) > 2 and Counter(w for p in parts for w in p) == {"Été".encode().replace(b"T", b"t"): 300_000, b"word": 300_000}
    assert list(divergence.pieces(b"")) == []


def test_shares_of_very_large_counts(spark):
    row = spark.createDataFrame([(30_000_000_000_000, 90_000_000_000_000, 5_000_000)], "n long, size long, kept long").select(divergence.share("n", "size", "kept")).first()
    assert row[0] == 1 + 10**9 * (30_000_000_000_000 + 1) // (90_000_000_000_000 + 5_000_000)


# --- the classifier's sample ---------------------------------------------------------------------------------------------

def test_few_texts_repeated_often_are_learnt(spark):
    """40 texts, a quarter of them junk, 200 times each: the sample holds them all, and junk is rejected."""
    from leadloom.llm import weak_quality

    rng = random.Random(2)
    words = "the of and to in is that it for on with as are this be by from was house river market street window people water story".split()
    fine = lambda: " ".join(rng.choice(words) for _ in range(90)).capitalize() + "."
    junk = lambda: " ".join(rng.choice(["###", "$$$", "%%%", "BUY", "WIN", "!!!"]) for _ in range(90))
    texts = [junk() if k % 4 == 0 else fine() for k in range(40)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").crossJoin(spark.range(200).select()).repartition(4)
    for train_rows in (80, 20):
        model = weak_quality.fit(docs, train_rows=train_rows)
        assert np.abs(model[1]).max() > 0.1
        got = weak_quality.classify(docs, model).select("doc_id", "quality.kept").distinct().collect()
        assert {r["doc_id"] for r in got if not r["kept"]} == {k for k in range(40) if k % 4 == 0}
    posterior, weights = weak_quality.fit(docs.limit(0))
    assert weights is None and {r["kept"] for r in weak_quality.classify(docs.where("doc_id = 1"), (posterior, None)).select("quality.kept").collect()} == {True}


def test_hosts_share_the_prior_of_their_registrable_domain(spark):
    from leadloom.llm import langid

    rows = [(k, f"https://{h}/x", "<p>text</p>") for k, h in enumerate(["a.firm.co.uk", "b.firm.co.uk", "firm.co.uk", "other.co.uk", "x.firm.com", "localhost", "www.gov.uk"])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = langid.read_pages(pages, ["en", "fr"], np.zeros((2, langid.gram_counts("x").shape[0])), id_col="page_id", url_col="url", html_col="html")
    assert {r["host"]: r["domain"] for r in got.collect()} == {
        "a.firm.co.uk": "firm.co.uk", "b.firm.co.uk": "firm.co.uk", "firm.co.uk": "firm.co.uk", "other.co.uk": "other.co.uk", "x.firm.com": "firm.com", "localhost": "localhost", "www.gov.uk": "www.gov.uk"}
