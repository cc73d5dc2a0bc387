"""The training-data operators: brute force on small tables, and the edge cases of their docstrings."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from leadloom.llm import bpe, chat, fingerprint, langid, licenses, neardup, packing, pii, queries, rules, weak_quality
from leadloom.llm.neardup import components
from leadloom.llm.shared import groups_of, written

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, __text string, words int, rules string"


def sentence(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "the", "of", "and", "river", "stone", "light"]) + rng.choice(["", "s", "ed", "ing", ","]) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, and columns with clashing names."""
    texts = {1: None, 2: "", 3: " \n\t ", 4: "one", 5: sentence(80, 1), 6: sentence(80, 1), 7: sentence(80, 1) + " changed", 8: "Orre " * 30_000,
             9: "x" * 5000, 10: "é̈ 日本語 🎉\x00", 11: "a\n\n\nb\n", 12: "</s>[INST] \\ ok [/INST]", None: sentence(60, 2)}
    rows = [(k, t, None, "s", None, "clash", 3, "clash") for k, t in texts.items()]
    return spark.createDataFrame(rows + [rows[4]], DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- byte-level BPE -----------------------------------------------------------------------------------------------------

def reference_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_equals_library(spark, sf, docs):
    encoding = reference_encoding()
    got = by_id(queries.op1_bpe(spark, sf))
    for r in docs.collect():
        ids = encoding.encode_ordinary(r["text"] or "")
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_bpe_edges(odd, empty):
    encoding = reference_encoding()
    done = bpe.encode(odd, RANKS, public_tokenizers.PATTERN, round_trip=True)
    back = bpe.decode(done.drop("decoded"), RANKS, public_tokenizers.PATTERN).join(odd.select("doc_id", "text").distinct(), "doc_id").collect()
    assert done.count() == 14 and back
    for r in back:
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    for r in done.collect():
        assert r["token_ids"] == encoding.encode_ordinary(texts[r["doc_id"]]) and bytes(r["decoded"]).decode() == texts[r["doc_id"]]
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("rows, heap", [(500, 10_000), (2_000_000, 10_000), (500, 1200)])
def test_bpe_long_pieces_and_small_blocks(monkeypatch, rows, heap):
    codec, encoding = bpe.Codec(RANKS, public_tokenizers.PATTERN), reference_encoding()
    rng = random.Random(5)
    pieces = ["".join(rng.choice(signs) for _ in range(n)) for n, signs in (
        (1, "a"), (2, "ab"), (40, "abcde"), (300, "abcdeéèthening"), (1023, "thening"), (1500, "abcdeéèthening"), (4000, "ing"), (3000, "x"), (1300, "日本語"), (1100, "-=#"))]
    monkeypatch.setattr(bpe, "QUERY_ROWS", rows)
    monkeypatch.setattr(bpe, "HEAP_PIECE", heap)
    for piece, ids in zip(pieces, codec.encode_pieces([p.encode() for p in pieces])):
        assert np.frombuffer(ids, np.int32).tolist() == encoding._encode_single_piece(piece.encode())


def test_bpe_equal_pairs_wait_for_lower_ranks():
    """A table in which contracting all equal pairs at once would pass over a merge of a lower rank."""
    ranks = {bytes([i]): i + 100 for i in range(256)} | {b"ab": 50, b"abc": 3, b"bab": 7, b"abab": 20, b"cab": 4}
    codec = bpe.Codec.__new__(bpe.Codec)
    codec.ranks, codec.con = ranks, None
    import duckdb
    import pyarrow as pa

    codec.con = duckdb.connect()
    merges = [(ranks[t[:i]], ranks[t[i:]], m) for t, m in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    codec._load("merges", pa.table({k: pa.array(x, pa.int32()) for k, x in zip("lrm", zip(*merges))}))
    codec.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
    rng = random.Random(2)
    for _ in range(60):
        text = "".join(rng.choice("aabbc") for _ in range(rng.randrange(2, 60))).encode()
        tokens = [text[i: i + 1] for i in range(len(text))]
        while found := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(tokens, tokens[1:])) if a + b in ranks]:
            _, i = min(found)
            tokens[i: i + 2] = [tokens[i] + tokens[i + 1]]
        assert np.frombuffer(codec._encode_long(text), np.int32).tolist() == [ranks[t] for t in tokens], text


def test_bpe_caches_and_long_texts(monkeypatch):
    codec, encoding = bpe.Codec(RANKS, public_tokenizers.PATTERN), reference_encoding()
    for name, value in (("GENERATION", 20), ("BATCH_CHARS", 200), ("BLOCK_PIECES", 30), ("DECODE_ROWS", 50)):
        monkeypatch.setattr(bpe, name, value)
    for k in range(6):
        texts = [sentence(n, n + k) for n in (1, 0, 70, 5, 400)] + [""]
        ids = codec.run(texts)
        assert [np.frombuffer(x, np.int32).tolist() for x in ids] == [encoding.encode_ordinary(t) for t in texts]
        assert [x.decode() for x in codec.decode_sequences(ids)] == texts


# --- quality rules --------------------------------------------------------------------------------------------------------

def base_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_rules_base(spark, sf, docs, odd, empty):
    got = by_id(queries.op6_rules(spark, sf))
    for r in docs.collect():
        x = got[r["doc_id"]]
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"], x["base_failed"]) == base_rules(r["text"])
        assert not (x["base_failed"] and x["kept"])
    weights = rules.gram_weights(odd, odd.where("doc_id = 5").select("doc_id"), buckets=64)
    scored = rules.apply_rules(odd, weights, buckets=64)
    assert scored.columns == odd.columns and scored.count() == 14
    for r in scored.collect():
        x = r["rules"]
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"], x["base_failed"]) == base_rules(r["text"])
    kept = rules.apply_rules(odd, weights, buckets=64, out_col="v").where("v.kept")
    assert {r["doc_id"] for r in kept.collect()} <= {5, 6, 7, None}
    assert rules.apply_rules(empty, rules.gram_weights(empty, empty.select("doc_id"), buckets=16), buckets=16).count() == 0


def test_rules_separate_labels(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    r = queries.op6_rules(spark, sf).where("not base_failed").join(labels, "doc_id")
    good = r.where("quality = 1").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    bad = r.where("quality = 0").agg(F.coalesce(F.avg(F.col("kept").cast("int")), F.lit(0.0))).first()[0]
    assert good > 0.97 and bad < 0.6


def test_weights_equal_brute_force(spark, docs):
    some = docs.select("doc_id", "text").where("doc_id < 40")
    got = rules.gram_weights(some, spark.range(0, 20).select(F.col("id").alias("doc_id")), buckets=32).first()["weights"]
    bucket = lambda *xs: some.sparkSession.range(1).select(F.pmod(F.xxhash64(*[F.lit(x) for x in xs]), F.lit(32))).first()[0]
    raw, good, cache = Counter(), Counter(), {}
    for r in some.orderBy("doc_id").limit(40).collect():
        for n in (1, 2):
            w = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
            for g in zip(*[w[i:] for i in range(n)]):
                cache.setdefault(g, None)
                raw[g] += 1
                good[g] += r["doc_id"] < 20
    rows = some.sparkSession.createDataFrame([(list(g),) for g in cache], "g array<string>")
    hashed = rows.select("g", F.when(F.size("g") == 1, F.xxhash64(F.col("g")[0])).otherwise(F.xxhash64(F.col("g")[0], F.get("g", F.lit(1)))).alias("h")).collect()
    r32, g32 = np.zeros(32), np.zeros(32)
    for x in hashed:
        r32[x["h"] % 32] += raw[tuple(x["g"])]
        g32[x["h"] % 32] += good[tuple(x["g"])]
    want = np.log((g32 + rules.SMOOTHING) / (r32 * g32.sum() / r32.sum() + rules.SMOOTHING))
    assert np.allclose(got, want)


# --- quality classifier -----------------------------------------------------------------------------------------------------

def test_classifier_held_out(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.op2_quality(spark, sf).join(labels, "doc_id").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    insulting = lambda r: sum(w in weak_quality.INSULTS for w in re.findall(r"\w+", r["text"].lower())) > 1
    right = np.mean([r["kept"] == (r["quality"] == 1 and not insulting(r)) for r in rows])
    clean = np.mean([r["kept"] for r in rows if r["quality"] == 1 and not r["toxic"]])
    assert right > 0.9 and clean > 0.97
    assert any(map(insulting, rows)) and not any(r["kept"] for r in rows if insulting(r))


def test_classifier_edges(odd, empty):
    model = weak_quality.fit(odd)
    got = weak_quality.classify(odd, model)
    assert got.columns == [*odd.columns, "quality"]
    rows = got.collect()
    assert len(rows) == 14 and all(not r["quality"]["kept"] for r in rows if r["doc_id"] in (1, 2, 3))
    assert len({r["quality"]["score"] for r in rows if r["doc_id"] in (5, 6)}) == 1
    assert weak_quality.classify(empty, weak_quality.fit(empty)).count() == 0


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    low = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    low = [w[:-1] if w[-1] in ".,;:!?\"'()" else w for w in low]
    n, grams = len(words), [tuple(low[i: i + 3]) for i in range(max(1, len(low) - 2))]
    letters = sum(c.isascii() and c.isalpha() for c in text) + sum(len(c.encode()) for c in text if not c.isascii())
    lines, raw = text.split("\n"), text.encode()
    ends = [raw[i - 1] for i in range(1, len(raw)) if raw[i] == 10] + [raw[-1]]
    insults = [w for w in low if w in weak_quality.INSULTS]
    return {
        "words": n, "symbols": sum(c in "#*$%&|<>" for c in text) / n, "capitals": sum("A" <= c <= "Z" for c in text) / max(1, letters),
        "exclamations": text.count("!") / n, "repetition": 1 - len(set(grams)) / len(grams), "variety": len(set(low)) / n, "word_length": sum(len(w.encode()) for w in words) / n,
        "function_words": sum(w in weak_quality.FUNCTION_WORDS for w in low) / n, "line_ends": np.mean([chr(c) in ".!?\"'" for c in ends]),
        "insults": len(insults), "insult_kinds": len(set(insults))}


def test_statistics_equal_plain_ones(docs):
    extra = ["You idiot, you moron! Trash.", "A  b\n\nC!\n", "x", "é É ü!\n| |"]
    for text in [r["text"] for r in docs.limit(120).collect()] + extra:
        got, want = weak_quality.statistics(text)[0], plain_statistics(text)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want), (text[:60], got, want)


def test_fit_equals_plain_em_and_scorer(spark, docs):
    """EM document by document, and the scorer's loss against a long plain descent."""
    some = docs.select("doc_id", "text").where("doc_id < 150")
    posterior, weights = weak_quality.fit(some)
    texts = [r["text"] for r in some.collect()]
    cast = [weak_quality.votes(weak_quality.statistics(t)[0]) for t in texts]
    k, n = len(weak_quality.LABELLERS), len(texts)
    pick = lambda one, both: [list(one if x in weak_quality.ONE_SIDED else both) for x in weak_quality.LABELLERS]
    prior = {0: pick(weak_quality.PRIOR_BAD_ONE, weak_quality.PRIOR_BAD), 1: pick(weak_quality.PRIOR_GOOD_ONE, weak_quality.PRIOR_GOOD)}
    p, share, weight = prior, weak_quality.PRIOR_SHARE, weak_quality.PRIOR_WEIGHT * n
    for _ in range(100):
        good = []
        for c in cast:
            a, b = share, 1 - share
            for j, v in enumerate(c):
                a, b = a * p[1][j][v], b * p[0][j][v]
            good.append(a / (a + b))
        p = {y: [[(sum(g if y else 1 - g for g, c in zip(good, cast) if c[j] == v) + weight * prior[y][j][v]) / (sum(g if y else 1 - g for g in good) + weight) for v in range(3)] for j in range(k)] for y in (0, 1)}
        share = (sum(good) + weight * weak_quality.PRIOR_SHARE) / (n + weight)
    for c, g in zip(cast, good):
        assert abs(posterior[weak_quality.pattern_of(c)] - g) < 1e-4
    distinct = sorted(set(texts))
    x, y = np.zeros((len(distinct), weak_quality.DIMENSIONS)), np.array([posterior[weak_quality.pattern_of(weak_quality.votes(weak_quality.statistics(t)[0]))] for t in distinct])
    for i, t in enumerate(distinct):
        index, value = weak_quality.features(*weak_quality.statistics(t))
        np.add.at(x[i], index, value)

    def loss(w):
        z = x @ w[:-1] + w[-1]
        return np.mean(np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z) + 5e-5 * (w @ w)

    w = np.zeros(weak_quality.DIMENSIONS + 1)
    for _ in range(1500):
        error = (1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) - y) / len(y)
        w -= 2.0 * (np.append(x.T @ error, error.sum()) + 1e-4 * w)
    assert loss(weights) < loss(w) + 0.01
    for r in weak_quality.classify(some, (posterior, weights)).limit(40).collect():
        i = distinct.index(r["text"])
        assert abs(r["quality"]["score"] - 1 / (1 + np.exp(-(x[i] @ weights[:-1] + weights[-1])))) < 1e-9
        assert r["quality"]["kept"] == (r["quality"]["score"] >= weak_quality.THRESHOLD)


def test_classifier_sample_with_null_and_equal_ids(spark, docs):
    """The sample goes by texts: ids that are null or alike neither fill nor empty it; copies count once."""
    some = docs.where("doc_id < 100").select(F.lit(None).cast("long").alias("doc_id"), "text")
    many = some.unionByName(some).unionByName(some)
    (_, a), (_, b) = weak_quality.fit(some), weak_quality.fit(some.withColumn("doc_id", F.lit(1).cast("long")))
    assert np.array_equal(a, b) and np.abs(a).sum() > 1
    assert np.abs(weak_quality.fit(many, train_rows=30)[1]).sum() > 1


def test_classifier_drops_insults_that_rules_keep(spark):
    rng, rows = random.Random(8), []
    vocabulary = [a + b for a in ("ta", "ri", "mo", "ne", "sul", "ver") for b in ("den", "lor", "mig", "ta", "res")]
    for k in range(600):
        text = [". ".join(" ".join(rng.choice(vocabulary + ["the", "of", "and", "in"]) for _ in range(9)).capitalize() for _ in range(9)) + "." for _ in range(2)]
        words = "\n".join(text).split(" ")
        if k % 12 == 0:
            for at in rng.sample(range(len(words)), 5):
                words[at] = rng.choice(["idiot", "moron", "stupid", "scum"])
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = rules.apply_rules(df, rules.gram_weights(df, df.select("doc_id"))).where("rules.kept")
    assert kept.count() == 600
    left = {r["doc_id"] for r in weak_quality.classify(kept, weak_quality.fit(kept)).where("quality.kept").collect()}
    assert left == {k for k in range(600) if k % 12}


def test_em_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    casts = [tuple(int(1 if (t if rng.random() < 0.9 else not t) else 2) for _ in weak_quality.LABELLERS) for t in truth]
    posterior, table, share = weak_quality.fit_labellers(dict(Counter(map(weak_quality.pattern_of, casts))))
    found = np.array([posterior[weak_quality.pattern_of(c)] > 0.5 for c in casts])
    assert (found == truth).mean() > 0.97 and abs(share - 0.8) < 0.05


# --- chat -------------------------------------------------------------------------------------------------------------------

def test_chat_reads_back(spark, sf):
    got = {r["conv_id"]: r for r in queries.op3_chat(spark, sf).collect()}
    rows = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        rows[r["conv_id"]].append((r["role"], r["text"] or ""))
    rows[-7] = [("user", queries.INJECTION), ("assistant", queries.INJECTION)]
    assert set(got) == set(rows)
    for k, turns in rows.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[k]["n_turns"] == len(turns) and got[k]["loss_chars"] == len(loss)
        assert got[k]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[k]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[k]["formatted_chars"] == len(chat.render_inst(turns))


@pytest.mark.parametrize("name", ["inst", "chatml"])
def test_chat_hostile_texts(name):
    render, parse = chat.TEMPLATES[name]
    parts = ["", " ", "\\", "</s>", "[INST]", " [/INST]", "[/ROLE]", "[/NAME]", "<|im_end|>", "<|im_sep|>", "<s>", "x", "\n", "[", "/INST]", "\\[INST]"]
    rng = random.Random(1)
    for _ in range(300):
        turns = [(rng.choice(["user", "assistant", "system", "", "[/NAME] x"]), "".join(rng.choices(parts, k=rng.randrange(6)))) for _ in range(rng.randrange(1, 6))]
        out = chat.locate(render, turns)
        assert parse(out.formatted) == turns and out.rewritten_at is None
        assert [chat.unescape(out.formatted[c:d]) for _, _, c, d in out.spans] == [t for _, t in turns]
        assert "".join(out.formatted[a:b] for a, b, _, _ in out.spans) == out.formatted[len(render([])):]


def test_chat_windows_and_rewriting():
    turns = [(("user", "assistant")[k % 2], f"text {k} \\ [INST]") for k in range(150)]
    assert chat.locate(chat.render_inst, turns) == chat.locate(chat.render_inst, turns, full_turns=1000)
    forgetful = lambda m: "".join(f"<{r}>{t if k >= len(m) - 2 else '..'}" for k, (r, t) in enumerate(m))
    assert chat.locate(forgetful, turns[:5]).rewritten_at == 2
    assert chat.locate(forgetful, turns).rewritten_at == 2
    assert chat.locate(lambda m: "".join(t for _, t in m) + f"#{len(m)}", turns[:3]).rewritten_at == 0


def test_chat_edges(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (None, 0, "assistant", ""), (None, 0, "assistant", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(turns)).collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [("user", ""), ("", "x"), ("", "x")]
    assert got[None]["loss_text"] == "b" and len(got[None]["turns"]) == 2
    assert chat.format_chats(turns.limit(0)).count() == 0


# --- language identification -------------------------------------------------------------------------------------------------

def test_langid(spark, sf):
    rows = queries.op4_langid(spark, sf).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    truth = {k: re.search(r"/(en|fr|de|es)/", p["url"])[1] for k, p in pages.items()}
    assert len(rows) == len(pages) and np.mean([r["lang"] == truth[r["page_id"]] for r in rows]) > 0.99


def test_langid_fuses_evidence_and_edges(spark, docs):
    langs, model = langid.fit_text_model(docs)
    french = "<html lang='fr'><body>le la les un une que des dans pour sur</body></html>"
    rows = [(k, f"https://a.b.example.fr/{k}", french) for k in range(20)] + [(100, "https://a.b.example.fr/x", "<body></body>"), (101, None, None), (102, "", "<html lang='zz'>"), (101, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("guess", F.lit(1))
    got = langid.identify(pages, langs, model).collect()
    found = {r["page_id"]: r for r in got}
    assert len(got) == 24 and all(found[k]["lang"] == "fr" for k in range(20))
    assert found[100]["lang"] == "fr" and found[100]["text_lang"] is None  # by its host and suffix
    assert found[101]["lang"] is not None and found[101]["probability"] < 1
    for r in got:  # the evidence adds up
        logs = np.sum([np.array(r["evidence"][k]) for k in ("text", "declared", "suffix", "host")], axis=0)
        assert langs[int(np.argmax(np.round(logs, 9)))] == r["lang"] and abs(1 / np.exp(logs - logs.max()).sum() - r["probability"]) < 1e-5
    assert langid.identify(pages.limit(0), langs, model).count() == 0
    assert {r["lang"] for r in langid.identify(pages, *langid.fit_text_model(docs.limit(0))).collect()} == {None}


def test_text_model_equals_plain_counts(docs):
    mask, odd_factor = (1 << 64) - 1, 0xD6E8FEB86659FD93

    def mix(x):
        for _ in range(2):
            x = (x ^ (x >> 32)) * odd_factor & mask
        return x ^ (x >> 32)

    some = docs.where("doc_id < 60")
    langs, model = langid.fit_text_model(some)
    counts = {lang: Counter() for lang in langs}
    for r in some.collect():
        text = " " + " ".join(re.findall(r"[^\W\d_]+", r["text"].lower())) + " "
        for a, b, c in zip(text, text[1:], text[2:]):
            counts[r["lang"]][mix((ord(a) << 42) ^ (ord(b) << 21) ^ ord(c)) % langid.DIMENSIONS] += 1
    for k, lang in enumerate(langs):
        row = np.array([counts[lang][d] + langid.GRAM_SMOOTHING for d in range(langid.DIMENSIONS)])
        assert np.allclose(model[k], np.log(row / row.sum()))


def test_fusion_equals_plain_counts(spark, sf, docs):
    """Counts over all pages, the page itself left out, smoothed host by domain by corpus: in plain loops."""
    langs, model = langid.fit_text_model(docs)
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    odd = spark.createDataFrame([(-1, None, None), (-2, "https://x.y.fr/a", "<html lang='fr'>"), (-2, "https://x.y.fr/a", "<html lang='fr'>"), (-3, "https://y.fr", "le la les")], "page_id long, url string, html string")
    pages = pages.select("page_id", "url", "html").unionByName(odd)
    rows, k = langid.read_pages(pages, langs, model).collect(), len(langs)
    tally = lambda key: {v: [sum(r["guess"] == i for r in rows if key(r) == v) for i in range(k)] for v in {key(r) for r in rows}}
    host, domain, suffix, declared = (tally(lambda r, c=c: r[c]) for c in ("host", "domain", "suffix", "declared"))
    every = [sum(r["guess"] == i for r in rows) for i in range(k)]
    want = defaultdict(list)
    for r in rows:
        less = lambda n, r=r: [max(0, x - (i == r["guess"])) for i, x in enumerate(n)]
        level = lambda n, above: [(x + langid.LEVEL_WEIGHT * p) / (sum(n) + langid.LEVEL_WEIGHT) for x, p in zip(n, above)]
        value = lambda n, kinds: [np.log((x + langid.VALUE_SMOOTHING / kinds) / (e + langid.VALUE_SMOOTHING)) for x, e in zip(less(n), less(every))]
        prior = level(less(host[r["host"]]), level(less(domain[r["domain"]]), level(less(every), [1 / k] * k)))
        logs = np.array(r["text"]) + np.log(prior)
        logs = logs + (value(declared[r["declared"]], len(declared)) if r["declared"] else 0) + (value(suffix[r["suffix"]], len(suffix)) if r["suffix"] else 0)
        best = int(np.argmax(np.round(logs, 9)))  # ties: the first language by code
        want[r["id"]].append((langs[best], 1 / np.exp(logs - logs[best]).sum()))
    got = defaultdict(list)
    for r in langid.identify(pages, langs, model).collect():
        got[r["page_id"]].append((r["lang"], r["probability"]))
    assert got.keys() == want.keys()
    for key in want:
        for (a, p), (b, q) in zip(sorted(got[key]), sorted(want[key])):
            assert a == b and abs(p - q) < 1e-5


def test_ties_go_to_the_first_language(spark):
    docs = spark.createDataFrame([(1, "abc abc", "bb"), (2, "abc abc", "aa")], "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(1, "https://a.com", "<body>abc</body>")], "page_id long, url string, html string")
    assert langid.identify(pages, *langid.fit_text_model(docs)).first()["lang"] == "aa"


def test_langid_rare_language_is_a_class(spark):
    rows = [(i, sentence(5, i % 50), "en") for i in range(5000)] + [(5000, "päivää huomenta kiitos näkemiin hyvää yötä", "fi")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, model = langid.fit_text_model(docs, train_rows=20)
    pages = spark.createDataFrame([(1, "", "<body>huomenta kiitos näkemiin</body>"), (2, "", f"<body>{sentence(9, 1)}</body>")], "page_id long, url string, html string")
    assert langs == ["en", "fi"] and {r["page_id"]: r["lang"] for r in langid.identify(pages, langs, model).collect()} == {1: "fi", 2: "en"}


# --- licenses -------------------------------------------------------------------------------------------------------------------

def test_licenses_brute_force(spark, sf, docs):
    got = {(r["doc_id"], r["first_line"]): (r["license"], r["dice"]) for r in queries.op5_licenses(spark, sf).collect() if r["first_line"] == r["last_line"]}
    want = {}
    for r in docs.collect():
        for i, line in enumerate((r["text"] or "").split("\n")):
            mine = licenses.bigrams(licenses.normalised(line))
            best = max(((licenses.dice(mine, licenses.bigrams(licenses.normalised(t))), name) for name, ts in licenses.TEMPLATES.items() for t in ts), key=lambda x: x[0])
            if best[0] >= licenses.THRESHOLD:
                want[r["doc_id"], i] = (best[1], best[0])
    assert got == want and want


def test_licenses_wrapped_and_edges(spark, odd, empty):
    mit = licenses.TEMPLATES["MIT"][1]
    wrapped = "\n".join(" * " + mit[i: i + 70] for i in range(0, len(mit), 70)).replace("Software", "software")
    ready = licenses.Templates()
    (match,) = ready.scan("intro\n" + wrapped + "\ncode()")
    assert match[2] == "MIT" and match[:2] == (1, 1 + wrapped.count("\n")) and match[3] > 0.9
    assert ready.scan("Licensed under CC BY-NC 4.0.")[0][2] == "CC-BY-NC-4.0" and ready.scan("licensed to nobody") == []
    assert licenses.scan_licenses(odd, id_col="doc_id").count() == 0 and licenses.scan_licenses(empty).count() == 0


def all_word_windows(text, templates):
    """Every window of words against every template; of overlapping windows the best."""
    words = licenses.normalised(text)
    lines = [k for k, line in enumerate(text.split("\n")) for _ in licenses.normalised(line)]
    found = []
    for name, known in ((n, licenses.bigrams(licenses.normalised(t))) for n, ts in templates.items() for t in ts):
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if (d := licenses.dice(licenses.bigrams(words[i:j]), known)) >= licenses.THRESHOLD:
                    found.append((-d, -len(known), name, j - i, i))
    chosen = []
    for d, _, name, n, i in sorted(found):
        if all(i + n <= c[0] or i >= c[0] + c[1] for c in chosen):
            chosen.append((i, n, name, -d))
    return [(lines[i], lines[i + n - 1], name, d) for i, n, name, d in sorted(chosen)]


def test_licenses_all_word_windows():
    templates = {"B": ["a b c d e", "a b"], "A": ["a b c"], "C": ["c d a b c d d e e a"]}
    ready, rng, n = licenses.Templates(templates), random.Random(4), 0
    for _ in range(400):
        text = "".join(rng.choice("aabbccddexy") + rng.choice(["  ", " ", " ", ".", "\n", "\n\n"]) for _ in range(rng.randrange(40)))
        assert ready.scan(text) == all_word_windows(text, templates), text
        n += len(ready.scan(text))
    assert n > 200


def test_licenses_inside_lines():
    ready, mit = licenses.Templates(), licenses.TEMPLATES["MIT"][1]
    assert ready.scan("Copyright 2020 Foo Inc. All rights reserved.") == [(0, 0, "All-Rights-Reserved", 1.0)]
    assert ready.scan("x\nSome prose. Released under the MIT License. More prose.") == [(1, 1, "MIT", 1.0)]
    assert ready.scan(f"{sentence(200, 3)} {mit} {sentence(200, 4)} All rights reserved. {sentence(9, 5)}") == [(0, 0, "MIT", 1.0), (0, 0, "All-Rights-Reserved", 1.0)]
    assert ready.scan("Some prose. Released under\nthe MIT License. More prose.") == [(0, 1, "MIT", 1.0)]


def test_licenses_larger_template_wins_ties():
    ready, bsd = licenses.Templates(), {k: licenses.TEMPLATES[f"BSD-{k}-Clause"][1] for k in (2, 3)}
    wrapped = bsd[3].replace(" 1. ", "\n1. ").replace(" 2. ", "\n2. ").replace(" 3. ", "\n3. ")
    assert ready.scan(wrapped) == [(0, 3, "BSD-3-Clause", 1.0)] and ready.scan(f"x y\n{bsd[3]}\nz") == [(1, 1, "BSD-3-Clause", 1.0)]
    assert ready.scan(f"x y\n{bsd[2]}\nz") == [(1, 1, "BSD-2-Clause", 1.0)]
    assert ready.scan("Released under the MIT License." + "\nfoo" * 300_000 + "\n" * 300_000 + "under") == [(0, 0, "MIT", 1.0)]  # ends, in linear time


# --- packing --------------------------------------------------------------------------------------------------------------------

def check_packing(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r["length"] for r in rows) // capacity)


def test_packing_equals_library(spark, sf, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    rows = queries.op7_packing(spark, sf).collect()
    want = {}
    for r in docs.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[a: a + 2048], dtype="<u4")
            want[r["doc_id"], k] = (a, len(part), zlib.crc32(part.tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    used, least = check_packing(rows, 2048)
    assert used <= least * 1.02 + 1


def test_best_fit_equals_one_by_one():
    rng = random.Random(0)
    for _ in range(60):
        capacity = rng.choice([10, 64, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(1, 300))]
        room = []
        for x in sorted(lengths, reverse=True):
            fits = [i for i, s in enumerate(room) if s >= x]
            if fits:
                room[min(fits, key=lambda i: room[i])] -= x
            else:
                room.append(capacity - x)
        rows = []
        for length, a, b, first, each, offset in packing.best_fit(Counter(lengths), capacity):
            rows += [{"length": length, "sequence_id": first + (k - a) // each, "offset": offset + (k - a) % each * length} for k in range(a, b)]
        assert Counter(r["length"] for r in rows) == Counter(lengths)
        assert check_packing(rows, capacity)[0] == len(room)


def test_packing_edges(odd, empty):
    rows = packing.pack_documents(odd, WORDS, capacity=64).collect()
    check_packing(rows, 64)
    assert {r["length"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1} and sum(r["piece"] == 0 for r in rows) == 14
    assert packing.pack_documents(empty, WORDS).count() == 0


def test_chunks_equal_whole_texts():
    from tokenizers import Tokenizer

    whole, mine = Tokenizer.from_file(WORDS), packing.ChunkTokenizer(WORDS)
    assert mine.in_chunks
    rng = random.Random(3)
    signs = list(" \t\n\x0b\x0c\r\x1c\x85\xa0 　aAß'stéé̈ΣσİK世1٣½#.!…") + ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", "ab.", "A!!", "é.", "x#'", "9…. "]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(25)))
        assert np.frombuffer(mine.encode([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_other_tokenizers_take_whole_texts(tmp_path):
    from tokenizers import Tokenizer, normalizers

    cased = Tokenizer.from_file(WORDS)
    cased.normalizer = normalizers.NFC()
    cased.save(str(tmp_path / "cased.json"))
    mine = packing.ChunkTokenizer(str(tmp_path / "cased.json"))
    text = "Some Text with CAPITALS<|endoftext|> and\nlines."
    assert not mine.in_chunks and np.frombuffer(mine.encode([text])[0], "<u4").tolist() == cased.encode(text, add_special_tokens=False).ids


# --- personal data ------------------------------------------------------------------------------------------------------------

def luhn(s):
    return sum((int(c) * 2 - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(s))) % 10 == 0


def test_pii_values(spark):
    texts = ["card 4111111111111111 and 4111 1111 1111 1111, not 4111111111111112.", "Born 1999-12-31 or 31.12.1999 or 12/31/1999, not 1999-02-30.",
             "SSN 123-45-6789, not 000-45-6789; call +1 (301) 555-0346.", "mail Jane.Doe7@mail.example.com from 192.168.0.1, not 300.1.1.1",
             "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000, not DE89370400440532013001", 'token = "8249aa8292c8e2d7dc8d8b760c301111bee22a2c"',
             "4111111111111112 4111111111111111", "9999-12-31 0001-01-01", None, "", "plain words"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, pii string")
    rows = {r["doc_id"]: r for r in pii.pseudonymise(df, "k").collect()}
    out = {k: r["text"] for k, r in rows.items()}
    a, b, c = re.findall(r"\d{4} ?\d{4} ?\d{4} ?\d{4}", out[0])
    assert luhn(a) and luhn(b.replace(" ", "")) and a != "4111111111111111" and c == "4111111111111112" and rows[0]["pii"]["card"] == 2
    assert out[6].startswith("4111111111111112 ") and out[6].endswith(" " + a)  # the same value, the same pseudonym
    days = re.findall(r"\d{4}-\d\d-\d\d", out[1])
    assert days[1] == "1999-02-30" and days[0] != "1999-12-31" and rows[1]["pii"]["date"] == 3
    iso = days[0].split("-")
    assert f"{iso[2]}.{iso[1]}.{iso[0]}" in out[1] and f"{iso[1]}/{iso[2]}/{iso[0]}" in out[1]
    assert "000-45-6789" in out[2] and "123-45-6789" not in out[2] and re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4}\.", out[2])
    assert "300.1.1.1" in out[3] and "192.168.0.1," not in out[3] and re.search(r"[A-Z][a-z]{3}\.[A-Z][a-z]{2}\d@", out[3])
    assert "DE89370400440532013001" in out[4] and rows[4]["pii"]["iban"] == 2 and "WEST 1234" not in out[4]
    for iban in re.findall(r"GB\d\d(?: \w{4}){4} \w\w|DE\d{20}", out[4])[:2]:
        s = iban.replace(" ", "")
        assert int("".join(str(int(x, 36)) for x in s[4:] + s[:4])) % 97 == 1
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', out[5]) and out[5] != texts[5]
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d{4}-\d\d-\d\d", out[7]) and rows[7]["pii"]["date"] == 2
    assert out[8] is None and out[9] == "" and out[10] == "plain words"
    assert {r["text"] for r in pii.pseudonymise(df, "other").where("doc_id = 6").collect()} != {out[6]}


def plain_pseudonym(value, kind, key):
    """A pseudonym by a plain Feistel network."""
    def prf(*parts):
        return int(hashlib.sha256("|".join([key, *map(str, parts), key]).encode()).hexdigest()[:12], 16)

    def numbers(tag, a, b, size_a, size_b):
        for r in range(pii.ROUNDS):
            a, b = (((a + prf(tag, r, b)) % size_a, b) if r % 2 == 0 else (a, (b + prf(tag, r, a)) % size_b))
        return a, b

    def characters(tag, text, alphabets):
        a, b = text[: len(text) // 2], text[len(text) // 2:]

        def shifted(text, r, by):
            out = ""
            for i, c in enumerate(text):
                alphabet = next((x for x in alphabets if c in x), None)
                out += alphabet[(alphabet.index(c) + prf(tag, r, i, by)) % len(alphabet)] if alphabet else c
            return out

        for r in range(pii.ROUNDS):
            a, b = (shifted(a, r, b), b) if r % 2 == 0 else (a, shifted(b, r, a))
        return a + b

    digits, lower, upper = pii.DIGITS, pii.LOWER, pii.UPPER
    if kind == "card":
        body = characters("card", value[:-1], [digits])
        return next(body + d for d in digits if luhn(re.sub("[^0-9]", "", body + d)))
    if kind == "iban":
        body = characters("iban", value[4:], [digits, upper])
        return next(f"{value[:2]}{c:02d}{body}" for c in range(2, 99) if int("".join(str(int(x, 36)) for x in body.replace(" ", "") + value[:2] + f"{c:02d}")) % 97 == 1)
    if kind == "ip":
        o = [int(x) for x in value.split(".")]
        a, b = numbers("ip", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if kind == "ssn":
        area, group, serial = map(int, value.split("-"))
        a, b = numbers("ssn", area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999)
        return f"{a + 1 + (a >= 665):03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"
    if kind == "date":
        import datetime

        days, size = datetime.date.fromisoformat(value).toordinal() - 1, pii.DATE_A * pii.DATE_B
        block, rest = divmod(days, size)
        sizes = (pii.DATE_LAST_A, pii.DATE_LAST_B) if block >= 50 else (pii.DATE_A, pii.DATE_B)
        a, b = numbers("date", rest // sizes[1], rest % sizes[1], *sizes)
        return datetime.date.fromordinal(block * size + a * sizes[1] + b + 1).isoformat()
    if kind == "email":
        last = value.rsplit(".", 1)[1]
        return characters("email", value[: len(value) - len(last)], [digits, lower, upper]) + last
    if kind == "phone":
        head = re.search(r"^\+[0-9]{1,3}(?=[ .(-])|^\+?", value)[0]
        return head + characters("phone", value[len(head):], [digits])
    alphabets = [digits, pii.HEX_LOWER, pii.HEX_UPPER] if re.fullmatch("[0-9a-fA-F]+", value) else [digits, lower, upper]
    return characters("secret", value, alphabets)


def test_pii_equals_plain_feistel(spark):
    rng = random.Random(7)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    values = [("card", "4111 1111 1111 1111"), ("card", "378282246310005"), ("iban", "GB82 WEST 1234 5698 7654 32"), ("iban", "DE89370400440532013000"),
              ("phone", "+1 (301) 555-0346"), ("phone", "301-555-0346"), ("email", "Jane.Doe7@mail.example.com"), ("email", "zoë_x@b-c.co.uk"),
              ("secret", "8249aa8292c8e2d7dc8d8b760c301111bee22a2c"), ("secret", "sk-AbC123_xyz-abcdefghijkl"), ("date", "9999-12-31"), ("date", "0001-01-01")]
    values += [("ssn", f"{rng.randrange(1, 666):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}") for _ in range(20)]
    values += [("ip", ".".join(str(rng.randrange(256)) for _ in range(4))) for _ in range(20)]
    values += [("date", f"{rng.randrange(1, 10000):04d}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}") for _ in range(40)]
    values += [("email", f"u{number(3)}@h{number(2)}.example.org") for _ in range(10)]
    df = spark.createDataFrame([(i, f"see {v} here", k) for i, (k, v) in enumerate(values)], "doc_id long, text string, kind string")
    for r in pii.pseudonymise(df, "secret key").collect():
        kind, value = values[r["doc_id"]]
        assert r["pii"][kind] == 1 and r["text"] == f"see {plain_pseudonym(value, kind, 'secret key')} here", (kind, value)


def test_pii_is_a_permutation(spark):
    n = 292 * 250
    days = spark.range(0, n, 37).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    got = pii.pseudonymise(days, "k").where("pii.date = 1")
    assert got.count() == days.count() == got.select("text").distinct().count()
    ips = spark.range(300).select(F.concat(F.lit("10.0.0."), (F.col("id") % 256).cast("string")).alias("text"))
    assert pii.pseudonymise(ips, "k").select("text").distinct().count() == 256


def test_pii_edges(odd, empty):
    got = pii.pseudonymise(odd, "k")
    assert got.columns == [*odd.columns, "pii"] and got.count() == 14 and pii.pseudonymise(empty, "k").count() == 0


# --- near-duplicates ------------------------------------------------------------------------------------------------------------

def brute_components(texts, percent=85, words=5):
    sets = {}
    for k, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[k] = {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    label = {k: k for k in texts}
    changed = True
    links = [(a, b) for a in texts for b in texts if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sets, label


@pytest.mark.parametrize("block", [2048, 7])
def test_near_duplicates_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block)  # 7: groups dealt by pairs of blocks
    rng = random.Random(4)
    texts, k = {}, 0
    for group in range(6):
        base = sentence(200, 100 + group).split()
        for copy in range(25):
            words = list(base)
            for _ in range(rng.randrange(0, 9)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            texts[k] = " ".join(words)
            k += 1
    texts |= {k: None, k + 1: "", k + 2: "few words", k + 3: "Few  WORDS", k + 4: "few words more", k + 5: texts[0]}
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(5)
    sets, label = brute_components(texts)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(df).collect()}
    assert {k: r["component_id"] for k, r in got.items()} == label
    assert {k: r["n_shingles"] for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
    assert all(r["kept"] == (label[k] == k) for k, r in got.items())
    _, label = brute_components(texts, percent=80)
    assert sorted(r["doc_id"] for r in neardup.deduplicate(df).collect()) == sorted(k for k in texts if label[k] == k)


def test_hamming_join_finds_all_pairs_in_distance(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 65536, (40, 32)).astype(np.uint16)
    marks, rows = [], []
    for i in range(40):
        other = base[i].copy()
        at = rng.choice(32, neardup.DISTANCE, replace=False)  # the worst case of the pigeonhole
        other[at] ^= np.uint16(1)
        marks += [base[i], other]
    alike = bytearray(range(neardup.SKETCH))
    df = spark.createDataFrame([(i, 50, bytearray(m.tobytes()), alike) for i, m in enumerate(marks)], "id long, n long, sig binary, sketch binary")
    labels = {r["node"]: r["label"] for r in components(neardup.hamming_join(df)).collect()}
    assert all(labels.get(2 * i + 1) == 2 * i for i in range(40))


def test_chain_of_resembling_texts_makes_no_cluster(spark, monkeypatch):
    """Each of 5,000 texts has a similarity near 0.6 with the next: no link, and no cluster to compare."""
    words = [f"w{i}" for i in range(5000 * 10 + 40)]
    rows = [(i, " ".join(words[10 * i: 10 * i + 44])) for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    tables = {}
    monkeypatch.setattr(neardup, "written", lambda d, label: tables.setdefault(label, written(d, label)))
    got = neardup.near_duplicates(df).collect()
    assert all(r["kept"] for r in got) and len(got) == 5000
    assert tables["members"].groupBy("cluster").count().where("count > 20").isEmpty()


def test_recall_at_080_against_all_pairs(spark):
    rng, texts = random.Random(9), {}
    for group in range(120):
        base = [f"g{group}w{i}" for i in range(150)]
        for copy in range(4):
            words = list(base)
            for at in rng.sample(range(150), rng.randrange(8)):
                words[at] = f"x{rng.randrange(10**9)}"
            texts[len(texts)] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    for percent in (80, 85):
        _, label = brute_components(texts, percent=percent)
        assert {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df, percent=percent).collect()} == label


def test_near_duplicate_edges(odd, empty):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == 14 and {r["component_id"] for r in rows if r["doc_id"] in (5, 6, 7)} == {5}
    assert all(r["component_id"] == r["doc_id"] and r["n_shingles"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    kept = [r["doc_id"] for r in neardup.deduplicate(odd).collect()]
    assert sorted(x for x in kept if x) == [1, 2, 3, 4, 5, 8, 9, 10, 11, 12] and None in kept
    assert neardup.near_duplicates(empty).count() == 0 and neardup.deduplicate(empty).count() == 0


def test_components_chain(spark):
    n = 200
    edges = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["label"] for r in components(edges).collect()} == {0}
    assert components(edges.limit(0)).count() == 0


def test_groups_of_runs_over_batches():
    import pyarrow as pa

    rng = random.Random(3)
    for _ in range(50):
        keys = sorted((rng.choice("abc"), rng.randrange(3)) for _ in range(rng.randrange(30)))
        table = pa.table({"k": pa.array([k for k, _ in keys], pa.string()), "p": pa.array([p for _, p in keys], pa.int64()), "v": pa.array(range(len(keys)), pa.int64())})
        groups = [g.to_pylist() for g in groups_of(iter(table.to_batches(max_chunksize=rng.randrange(1, 9))), ["k", "p"])]
        assert [r["v"] for g in groups for r in g] == list(range(len(keys)))
        assert [(g[0]["k"], g[0]["p"]) for g in groups] == sorted(set(keys)) and all(len({(r["k"], r["p"]) for r in g}) == 1 for g in groups)


# --- fingerprints ----------------------------------------------------------------------------------------------------------------

def test_fingerprints(spark, sf, docs):
    rows = docs.orderBy("doc_id").collect()
    got = by_id(queries.op10_fingerprint(spark, sf))
    seen = {}
    for k, r in enumerate(rows):
        text, after = r["text"], rows[(k + 1) % len(rows)]["text"]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        x = got[r["doc_id"]]
        assert x["n_chars"] == len(text) and x["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(text, x["fingerprint"]) == x["fingerprint"]
        assert (x["fingerprint"] == x["edited_fingerprint"]) == (text == edited) and 0 <= x["near_next"] <= 1
        if len(text) > 100 and text != after:
            assert x["near_edited"] > x["near_next"]
    assert len(set(seen.values())) == len(seen)


def test_next_crosses_buckets(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "PART_ROWS", 3)
    ids = [None, *random.Random(2).sample(range(10**9), 30), *range(5000, 5040), -5, 7, 7]
    df = spark.createDataFrame([(i, f"text {i} {n if i == 7 else ''}") for n, i in enumerate(ids)], "doc_id long, text string").repartition(4)
    rows = fingerprint.with_next(df, share=100).collect()
    order = sorted(((i is not None, i or 0, t) for i, t in df.collect()))
    want = {(i, t): order[(k + 1) % len(order)][2] for k, (_, i, t) in enumerate(order)}
    assert {((r["doc_id"] or 0), r["text"]): r["next"]["text"] for r in rows} == want and len(rows) == len(ids)


def test_next_with_any_ids(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "PART_ROWS", 3)
    ids = [-2**63, 2**63 - 1, 10**15, *range(2**62, 2**62 + 40), *range(300), *[None] * 60, *[5] * 30]
    df = spark.createDataFrame([(i, f"{n * 7919 % 1000} text") for n, i in enumerate(ids)], "doc_id long, text string").repartition(4)
    rows = fingerprint.with_next(df, share=100).collect()
    order = sorted(((i is not None, i or 0, t) for i, t in df.collect()))
    want = {(i, n, t): order[(k + 1) % len(order)][2] for k, (n, i, t) in enumerate(order)}
    assert {(r["doc_id"] or 0, r["doc_id"] is not None, r["text"]): r["next"]["text"] for r in rows} == want and len(rows) == len(ids)


def test_keys_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "PART_ROWS", 1000)
    asked = []
    monkeypatch.setattr(fingerprint, "written", lambda df, label: asked.append(written(df, label)) or asked[-1])
    rows = spark.range(20_000).select(F.when(F.col("id") < 6000, None).when(F.col("id") == 7000, 9 * 10**18).otherwise(F.col("id")).alias("doc_id"),
                                      F.concat(F.lit("text "), "id").alias("text"))  # null ids, dense ids and one far away
    assert fingerprint.with_next(rows).count() == 20_000
    sizes = [r["count"] for r in asked[1].groupBy("part").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 2 * 1000


def test_texts_are_shuffled_once(spark, sf):
    df = queries.op10_fingerprint(spark, sf)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 1 and final.count("REPARTITION_BY_NUM") == 2  # the reused one is named again


def test_equal_rows_are_one_document(spark):
    df = spark.createDataFrame([(1, "a" * 9)] * 5 + [(2, "b" * 50)] + [(None, "c")] * 3, "doc_id long, text string")
    got = [(r["doc_id"], r["next"]["text"]) for r in fingerprint.with_next(df).collect()]
    assert sorted(got, key=str) == sorted([(1, "bb")] * 5 + [(2, "c")] + [(None, "")] * 3, key=str)


def test_edit_span_and_edges(spark, odd, empty):
    df = spark.createDataFrame([("a\nb\nc\nd", "a\nX\nY\nc\nd"), ("same", "same"), ("", "x")], "p string, q string")
    df = fingerprint.with_tree(fingerprint.with_tree(df, "p", "tp"), "q", "tq")
    spans = [r[0] for r in df.select(fingerprint.edit_span(F.col("tp"), F.col("tq"))).collect()]
    assert tuple(spans[0]) == (1, 1, 2) and spans[1] is None and tuple(spans[2]) == (0, 0, 0)
    rows = fingerprint.with_next(odd).collect()
    assert len(rows) == 14 and all(r["next"] is not None for r in rows)
    assert fingerprint.with_next(empty).count() == 0 and fingerprint.with_next(odd.where("doc_id = 5").limit(1), share=1).first()["next"]["text"] == sentence(80, 1)


def merkle(text):
    """A plain Merkle tree: (root, sections), a section (node, paragraphs), a paragraph (node, leaves)."""
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    sections, open_section = [], []
    lines = text.split("\n")
    for k, line in enumerate(lines):
        leaves = [digest(c)[:16] for c in re.findall(r"[^.!?]{0,15}[.!?]+ ?|[^.!?]{1,16}", line)]
        open_section.append((digest("".join(leaves))[:32], leaves))
        if open_section[-1][0][0] in "08" or k + 1 == len(lines):
            sections.append((digest("".join(n for n, _ in open_section))[:32], open_section))
            open_section = []
    return digest("".join(n for n, _ in sections)), sections


def test_tree_equals_plain_merkle(spark, docs):
    texts = ["", "\n", "a\n\nb", "x" * 40, "One. Two! Three?! ..."] + ["\n".join(sentence(n % 13, n + k) + "." for n in range(k)) for k in (5, 40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").unionByName(docs.select("text").limit(40))
    for r in fingerprint.with_tree(df, "text", "t").withColumn("f", fingerprint.fingerprint(F.col("t"))).collect():
        root, sections = merkle(r["text"])
        assert r["t"]["root"] == root and [(s["node"], [(p["node"], p["chunks"]) for p in s["paragraphs"]]) for s in r["t"]["sections"]] == sections
        assert r["f"] == root + ":" + "/".join(n[:8] + "=" + ".".join(p[:8] + "".join(c[:6] for c in cs) for p, cs in ps) for n, ps in sections)


def plain_likeness(a, b):
    """Likeness of two fingerprints, level by level, and from the ends."""
    if a == b:
        return 1.0
    level = lambda f: f.split(":")[1].split("/")
    inner = lambda ss: [p for s in ss for p in s.split("=")[1].split(".")]
    leaves = lambda ps: [p[i: i + 6] for p in ps for i in range(8, len(p), 6)]
    less = lambda x, y: [v for v in dict.fromkeys(x) if v not in y]
    both = lambda x, y: [v for v in dict.fromkeys(x) if v in y]
    sa, sb = level(a), level(b)
    n = len(leaves(inner(both(sa, sb))))
    p, q = inner(less(sa, sb)), inner(less(sb, sa))
    n += len(leaves(both(p, q)))
    la, lb = leaves(less(p, q)), leaves(less(q, p))
    x, y = set(la), set(lb)
    longest = n + max(len(la), len(lb))
    if not longest:
        return 0.0
    run = lambda u, v: next((i for i, (c, d) in enumerate(zip(u, v)) if c != d), min(len(u), len(v)))
    ends = n + min(run(la, lb) + run(la[::-1], lb[::-1]), len(la), len(lb))
    return max(2 * (n + len(x & y)) / (2 * n + len(x) + len(y)), ends / longest)


def test_likeness_comes_from_the_fingerprint(spark, sf):
    rows = queries.op10_fingerprint(spark, sf).collect()
    after = dict(zip((r["doc_id"] for r in sorted(rows, key=lambda r: r["doc_id"])), [r["fingerprint"] for r in sorted(rows, key=lambda r: r["doc_id"])][1:] + [min(rows, key=lambda r: r["doc_id"])["fingerprint"]]))
    for r in rows:
        assert abs(r["near_edited"] - plain_likeness(r["fingerprint"], r["edited_fingerprint"])) < 1e-12
        assert abs(r["near_next"] - plain_likeness(r["fingerprint"], after[r["doc_id"]])) < 1e-12


def test_edit_span_equals_plain_search(spark):
    rng, pairs = random.Random(6), []
    for k in range(60):
        lines = [sentence(rng.randrange(4), rng.randrange(30)) for _ in range(rng.randrange(1, 40))]
        other = list(lines)
        a = rng.randrange(len(lines))
        other[a: rng.randrange(a, len(lines) + 1)] = [f"new {k} {i}" for i in range(rng.randrange(3))]
        pairs.append(("\n".join(lines), "\n".join(other)))
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k long, p string, q string")
    df = fingerprint.with_tree(fingerprint.with_tree(df, "p", "tp"), "q", "tq")
    for r in df.select("k", fingerprint.edit_span(F.col("tp"), F.col("tq")).alias("s")).collect():
        p, q = (x.split("\n") for x in pairs[r["k"]])
        if p == q:
            assert r["s"] is None
            continue
        head = next((i for i, (x, y) in enumerate(zip(p, q)) if x != y), min(len(p), len(q)))
        tail = next((i for i, (x, y) in enumerate(zip(p[::-1], q[::-1])) if x != y), min(len(p), len(q)))
        tail = min(tail, min(len(p), len(q)) - head)
        # repeated lines at the border of an insertion may be counted to either side
        assert (r["s"]["last_a"] - r["s"]["first"], r["s"]["last_b"] - r["s"]["first"]) == (len(p) - tail - 1 - head, len(q) - tail - 1 - head) and r["s"]["first"] == head


# --- pipeline and SQL -----------------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark, sf, docs):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_dedup", "pseudonyms", "best_fit_packing"]
    now, counts = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = written(stage(spark, now, sf), name)
        assert now.columns == docs.columns
        counts.append(now.count())
    assert counts[0] > counts[1] >= counts[2] > counts[3] == counts[4]
    last = corpus_pipeline.STAGES[-1][1](spark, now, sf).collect()
    assert {r["doc_id"] for r in last} == {r["doc_id"] for r in now.collect()}
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert ids == {r["doc_id"] for r in last}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name]).df()
    got = queries.QUERIES[name](spark, sf).toPandas()[list(want.columns)]
    order = list(want.columns)
    a, b = (d.sort_values(order).astype(str).values.tolist() for d in (want, got))
    assert a == b
