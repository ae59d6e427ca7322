"""The corpus operators against brute force, round trips and held-out accuracy, on small tables with every odd case."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import (ann, decontaminate, encode, graph, langid, ngram_lm, packing, queries, secret_ledger, shards, simhash,
                         token_files, toxicity)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, root string, node long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()


def _texts():
    rnd = random.Random(3)
    base = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 60))) for _ in range(30)]
    near = [b.replace("alpha", "Alpha", 1) for b in base[:5]]
    return base + near + base[:8] + [None, "", "   ", "\n\t", "one", "one two", "é ü 日本語 tést", "x" * 5000, " ".join(WORDS * 400)]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, blanks, ties, repeated rows, a null id, a long text, and columns whose names clash with the operators' own."""
    texts = _texts()
    rows = [(i, t, "ab"[i % 2] if i % 5 else None, "s", len(t or ""), "r", i) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "no id here", None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def _brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("tile", [1 << 16, 4])
def test_simhash_against_all_pairs(docs, none, tile):
    rows = docs.collect()
    prints = [_brute_fingerprint(r["text"]) for r in rows]
    got = simhash.near_duplicates(docs, tile=tile).collect()
    assert sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["fingerprint"]) for r in got) == sorted(
        ((r["doc_id"] if r["doc_id"] is not None else -1), f"{p:016x}") for r, p in zip(rows, prints))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for r, g in zip(rows, group):
        if r["doc_id"] is not None:
            least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    want = {(r["doc_id"], least.get(g)) for r, g in zip(rows, group)}
    assert {(r["doc_id"], r["component_id"]) for r in got} == want
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(least.values()))


def test_simhash_long_text_in_pieces(monkeypatch):
    text = " ".join(WORDS * 50)
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprint(text.encode()) == whole == _brute_fingerprint(text)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_langid(given, docs, none):
    got = langid.identify(given).join(given.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95 and all(0 <= r["score"] <= 1 for r in got)
    odd = {(r["doc_id"], r["lang_pred"]) for r in langid.identify(docs).collect()}
    blank = {r["doc_id"] for r in docs.collect() if not any(c.isalpha() for c in r["text"] or "")}
    assert {d for d, lang in odd if lang == "und"} == blank
    assert langid.identify(none).count() == 0 and langid.keep_known(none).count() == 0
    assert langid.keep_known(given).count() == given.count()


def test_kernel_counts_match_sets(monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 5)
    grams = langid.Grams("abcdefgh")
    for text in ("abc abd", "a", "hhhhh", "abcdefghabcdefgh ab", "A--b!!c"):
        folded = re.sub(r"[^a-z]+", " ", " " + text.lower())
        want = {folded[i:i + n] for n in (1, 2, 3) for i in range(len(folded) - n + 1)}
        assert grams.of(text)[0] == len(want), text


@pytest.mark.parametrize("points", [16, 1 << 14])
def test_shards_against_greedy(docs, none, points):
    rows = docs.collect()
    sizes = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        sizes[r["text"]] = sizes.get(r["text"], 0) + len((r["text"] or "").encode()) + 1
    # groups stand by smallest id, null first; ties (null id) by content address
    def greedy(cap):
        out, used, n = {}, 0, 0
        for t, s in sizes.items():
            if used + s > cap:
                n, used = n + 1, 0
            used += s
            out[t] = n
        return out
    best = min(c for c in range(max(sizes.values()), sum(sizes.values()) + 1) if max(greedy(c).values()) < 4)
    got = shards.shard(docs, 4, points=points).collect()
    want = greedy(best)
    text = {r["doc_id"]: r["text"] for r in rows}
    assert all(r["shard"] == want[text[r["doc_id"]]] and r["text_crc32"] == zlib.crc32((text[r["doc_id"]] or "").encode()) for r in got)
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert len(got) == len(rows) and shards.shard(none, 4).count() == 0


def test_backoff_lm(docs, none, monkeypatch):
    monkeypatch.setattr(ngram_lm, "BLOCK_WORDS", 500)
    monkeypatch.setattr(ngram_lm, "HELD_BYTES", 1000)
    monkeypatch.setattr(ngram_lm, "HOT", 30)
    rows = docs.collect()
    words = [(r["text"] or "").encode().lower().split() for r in rows]
    one, two = Counter(w for x in words for w in x), Counter(p for x in words for p in zip(x, x[1:]))
    want = []
    for r, x in zip(rows, words):
        s = math.log(one[x[0]] / one.total()) if x else 0.0
        s += sum(math.log(two[p] / one[p[0]]) if two[p] >= 2 else math.log(0.4 * one[p[1]] / one.total()) for p in zip(x, x[1:]))
        want.append((-1 if r["doc_id"] is None else r["doc_id"], len(x), s))
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["log_score"]) for r in ngram_lm.score(docs).collect())
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:2] == w[:2] and abs(g[2] - w[2]) < 1e-5
    assert ngram_lm.score(none).count() == 0


def test_ann(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(600, 16)).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(1000 + i, x[5].tolist(), 0) for i in range(50)]                       # equal vectors: ties to the smaller id
    rows += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] + [1.0] * 15, 0), (2003, [None] * 16, 0), (2020, [], 0),
             (2040, [float("inf")] * 16, 0), (None, [1.0] * 16, 0), rows[40]]
    schema = "vec_id long, embedding array<float>, score int"
    got = ann.search(spark.createDataFrame(rows, schema).repartition(3)).collect()
    usable = {i: np.array(v, dtype=float) for i, v, _ in rows[:650]}
    hits = total = 0
    for q in [i for i in usable if i % 20 == 0]:
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        want = sorted(((-float((usable[q] * v).sum()), i) for i, v in usable.items() if i != q))[:20]
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        assert all(abs(r["score"] - float((usable[q] * usable[r["vec_id"]]).sum())) < 1e-12 for r in mine)
        hits, total = hits + len({r["vec_id"] for r in mine} & {i for _, i in want}), total + 20
    assert hits / total >= 0.9 and {r["query_id"] for r in got} == {i for i in usable if i % 20 == 0}
    assert ann.search(spark.createDataFrame([], schema)).count() == 0


def test_probe_order():
    fraction = np.array([0.1, 0.45, 0.8])
    sets = ann.probe_sets(fraction, 27)
    cost = [sum((fraction[h] if s < 0 else 1 - fraction[h]) ** 2 for h, s in moves) for moves in sets]
    assert cost == sorted(cost) and len({tuple(sorted(m)) for m in sets}) == len(sets) == 27


def test_toxicity(spark, given, docs, none):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    big = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(big.where("doc_id % 3 <> 0"), known)
    got = toxicity.score(big.where("doc_id % 3 = 0"), model).join(known.withColumnRenamed("toxic", "y"), "doc_id").collect()
    clean = [r for r in got if r["y"] == 0]
    print("false", sum(r["toxic"] for r in clean), len(clean), "found", sum(r["toxic"] for r in got if r["y"] == 1), sum(r["y"] for r in got))
    assert sum(r["toxic"] for r in clean) <= 0.005 * len(clean)
    assert sum(r["toxic"] for r in got if r["y"] == 1) >= 0.85 * sum(r["y"] for r in got)
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and not any(r["toxic"] for r in odd)
    assert toxicity.classify(none, labels).count() == 0
    assert toxicity.classify(docs, labels.limit(0)).where("toxic or p_toxic is not null").count() == 0


def test_chain_uses_out_of_fold_probabilities():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(400, 5))
    first = x[:, 0] > 0
    targets = np.column_stack([first, first & (x[:, 1] > -1)]).astype(float)
    models = toxicity.fit_chain(x, targets, np.arange(400) % 5)
    assert [len(m) for m in models] == [6, 7]
    p = toxicity.run_chain(x, models)
    assert ((p > 0.5) == targets.astype(bool)).mean() > 0.9


SECRETS = ['password = "hunter22x"', "Token:abc", "api_key=AAAAAA", "AKIA" + "A1" * 8, "AKIAX", "AKIAAKIA" + "Z" * 12, "0" * 24, "f" * 23,
           "secret: token: 0123456789abcdef0123456789abcdef", "é日本 passwd='zzzzzz'", "\x01\x02 apikey:=q1w2e3r4", None, "", "clean",
           "PASSWORD==abcdefgh token=token=abcdef", "-----BEGIN RSA PRIVATE KEY-----", "ſecret = abcdefgh", "a𝄞 api-key token = 'abc.def/ghi'"]


def _base(text):
    kinds = [("assign", r"((?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)", 6),
             ("access", r"()(AKIA[A-Z0-9]+)", 20), ("hex", r"()([0-9a-f]+)", 24)]
    out = []
    for o, (k, p, n) in enumerate(kinds):
        flags = re.I | re.A if o == 0 else 0
        if o == 0:
            p = p.replace("((?:", "((?i:").replace("key)", "key)")
        out += [(m.start(), o, m.end(), k) for m in re.finditer(p, text or "", flags if o == 0 else 0) if len(m[2]) >= n]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_secrets_against_re(spark, none):
    df = spark.createDataFrame([(i, s, "b") for i, s in enumerate(SECRETS * 2)] + [(None, "token = abcdef", "b")], "doc_id long, text string, blob string")
    got = secret_ledger.digest(df).collect()
    assert len(got) == len(SECRETS) * 2 + 1
    for r in got:
        text = SECRETS[r["doc_id"] % len(SECRETS)] if r["doc_id"] is not None else "token = abcdef"
        want = _base(text)
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (text, want, r["spans"])
        assert (r["n_assign"], r["n_hex"]) == (want.count("assign:"), want.count("hex:"))
    assert any(r["spans"].startswith("pem:") for r in got) and secret_ledger.digest(none).count() == 0


def test_ledger_scans_only_unseen_pairs(spark):
    one = spark.createDataFrame([(1, "token = abcdef"), (2, "clean"), (3, "token = abcdef")], "doc_id long, text string")
    _, first = secret_ledger.scan_paths(one, rules=secret_ledger.BASE)
    assert first.count() == 2 * 3
    ledger = spark.createDataFrame(first.collect(), first.schema)
    two = one.union(spark.createDataFrame([(1, "AKIA" + "B" * 16)], "doc_id long, text string"))
    found, new = secret_ledger.scan_paths(two, ledger, secret_ledger.BASE)
    assert new.count() == 3                                                      # one new blob
    assert sorted((r["doc_id"], len(r["spans"])) for r in found.collect()) == [(1, 1), (1, 1), (2, 0), (3, 1)]
    _, more = secret_ledger.scan_paths(one, ledger, secret_ledger.RULES)
    assert {r["kind"] for r in more.collect()} == {"pem", "forge"}                # old blobs, new rules only


def test_redaction(spark):
    df = spark.createDataFrame([(1, "x token = 'abcdef0123456789abcdef0123' y é", 99), (2, "clean", 5), (3, None, None)],
                               "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in secret_ledger.redact(df).collect()}
    assert got == {1: ("x [SECRET]' y é", 15), 2: ("clean", 5), 3: (None, None)}


def _edit_distance_in(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_myers_and_pigeonhole(spark, none):
    rnd = random.Random(5)
    for _ in range(200):
        item = "".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 80)))
        text = "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 120)))
        assert decontaminate.distance(item, text)[0] == _edit_distance_in(item, text)
    items = [" ".join(rnd.choice(WORDS) for _ in range(25)) for _ in range(6)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)] + [(6, None, "x"), (None, "a", "x"), (7, "?!", "x"), (0, items[0], "x")],
                                  "item_id long, text string, doc_id string")

    def spoil(t, n):
        for _ in range(n):
            p = rnd.randrange(len(t))
            t = t[:p] + rnd.choice(["", "q", t[p] + "z"]) + t[p + 1:]
        return t
    texts = [f"Intro, {t.upper()}! end" for t in items] + ["before " + spoil(t, n) + " after" for t in items for n in (2, 5, 8, 14, 30)]
    texts += [None, "", "alpha beta gamma", " ".join(WORDS * 300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.report(df, bench).collect()}
    few = {r["doc_id"]: r["item_ids"] for r in decontaminate.report(df, bench, pieces=10).collect()}
    for i, t in enumerate(texts):
        norm = decontaminate.normalise(t or "")
        want = [k for k, it in enumerate(items) if _edit_distance_in(it, norm) <= decontaminate.budget(it)]
        assert got[i] == few[i] == want, (i, t)
    assert decontaminate.report(none, bench).count() == 0
    assert decontaminate.report(df, bench.limit(0)).where("contaminated").count() == 0


def _end_distance(item, text):
    """Edit distances of ``item`` to the whole of ``text``."""
    row = list(range(len(text) + 1))
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return row[-1]


def test_items_of_every_length_have_one_rule(spark):
    rnd = random.Random(12)
    assert [decontaminate.budget("x" * n) for n in (1, 16, 17, 33, 34, 49, 50, 100)] == [0, 0, 1, 1, 2, 2, 3, 6]
    words = ["".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    items = ["cat", "The capital of France is Paris", "a"]
    for n in range(1, 61):
        items.append((" ".join(rnd.choice(words) for _ in range(40)))[:n].strip() or "b")
    items = [decontaminate.normalise(t) for t in items]
    matcher = decontaminate.Matcher(list(enumerate(items)))

    def spoil(t, n):
        for _ in range(n):
            p = rnd.randrange(len(t))
            t = t[:p] + rnd.choice(["", "q", t[p] + "z"]) + t[p + 1:]
        return t
    texts = ["a concatenation of things", "The capitalx of France is Paris.", "the capital of france is bparisb", "", "cat", "dog, CAT!"]
    texts += [f"{rnd.choice(['', 'so ', 'q'])}{spoil(t, n)}{rnd.choice(['', ' it', 'q'])}" for t in items for n in (0, 1, 3)]
    for text in map(decontaminate.normalise, texts):
        got = {i: (a, b, d) for i, a, b, d in matcher.search(text)}
        for i, item in enumerate(items):
            least = _edit_distance_in(f" {item} ", f" {text} ")
            assert (i in got) == (least <= decontaminate.budget(item)), (item, text)
            if i in got:
                a, b, d = got[i]
                assert d == least and 0 <= a <= b <= len(text)
                padded = f" {text} "            # the stretch with or without the blanks around it is that near
                assert any(_end_distance(f" {item} ", padded[s:e]) == d for s in (a, a + 1) for e in (b + 1, b + 2)), (item, text, a, b)
    bench = spark.createDataFrame(list(enumerate(items[:3])), "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(texts[:6])), "doc_id long, text string")
    assert {r["doc_id"]: r["item_ids"] for r in decontaminate.report(df, bench).collect()} == {0: [2], 1: [1], 2: [], 3: [], 4: [0], 5: [0]}


ODD = ["", " ", "  a  b", "a \n b", "\n\nx ", " lead", "tail ", "a b c", "x\t y  z\n", "It's  'll", "ÀÉ é ́x", "<|endoftext|> hi",
       "日本語 テスト 12", "a\x1cb c", "ΑΣ ΣΑΣ.", "İ ŉ ﬁ ² x² Ⅷ", "a.\nB c.\n\nd", "ß.É,Ý", "word " * 300, "x" * 500]


@pytest.mark.parametrize("name,make", [("byte_bpe_50k.json", encode.byte_level_encoder), ("word_bpe_49k.json", encode.lower_word_encoder)])
def test_encoders_equal_the_library(given, name, make):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(name)
    library, mine = Tokenizer.from_file(path), make(path)
    library.encode_special_tokens = True
    rnd = random.Random(2)
    odd = ODD + ["".join(rnd.choice([" ", "\n", "a", "B", "é", "1", ".", "'s", "\t", " ", "́", "²", "()"]) for _ in range(20)) for _ in range(3000)]
    for t in odd + [r["text"] for r in given.limit(60).collect()]:
        assert np.frombuffer(mine(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_token_files_round_trip(docs, none, tmp_path):
    import public_tokenizers
    make = queries.byte_encoder()
    folder = f"file://{tmp_path}/ids"
    manifest = token_files.write_token_files(docs, folder, make, 2, text_bytes=4000, file_bytes=600)
    rows = manifest.collect()
    assert len(rows) > 3 and sum(r["n_docs"] for r in rows) == docs.count()
    mine = encode.byte_level_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for doc_id, ids in token_files.read_documents([r["path"] for r in rows], [3, 11, 40]):
        assert ids.tobytes() == mine(text[doc_id]) + b"\x02\0\0\0"
    got = sorted(token_files.token_spans(docs, make, 2).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got][1:] == sorted(r["doc_id"] for r in docs.collect() if r["doc_id"] is not None)
    at = 0
    for r in got:
        ids = mine(text[r["doc_id"]]) + b"\x02\0\0\0"
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    assert token_files.token_spans(none, make, 2).count() == 0
    path = rows[0]["path"].removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[12] ^= 0xFF
    open(path, "wb").write(data)
    with pytest.raises(Exception):
        [token_files.FileReader(rows[0]["path"]).get(p) for p in range(rows[0]["n_docs"])]


def test_packing(docs, none):
    import public_tokenizers
    mine = encode.lower_word_encoder(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack(docs, queries.word_encoder(), 0, capacity=64).collect()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        ids = mine(text[r["doc_id"]]) + b"\0\0\0\0"
        part = ids[4 * r["start"]:4 * (r["start"] + r["length"])]
        assert r["start"] == 64 * r["piece"] and zlib.crc32(part) == r["ids_crc32"] and len(part) == 4 * r["length"]
    assert sum(r["length"] for r in got) == sum(len(mine(r["text"])) // 4 + 1 for r in docs.collect())
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in sequences.values():
        s.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and s[0][0] == 0 and sum(n for _, n in s) <= 64
    assert packing.pack(none, queries.word_encoder(), 0).count() == 0


def test_plan_is_best_fit_decreasing():
    rnd = random.Random(4)
    for _ in range(50):
        lengths = sorted((rnd.randint(1, 40) for _ in range(rnd.randint(0, 200))), reverse=True)
        rooms = []
        for n in lengths:
            fit = [r for r in rooms if r >= n]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - n)
            else:
                rooms.append(40 - n)
        rows, n_sequences = packing.plan(Counter(lengths), 40)
        assert sum(r[2] for r in rows) == len(lengths)
        assert n_sequences <= len(rooms) and n_sequences >= -(-sum(lengths) // 40)


def test_pipeline_against_its_stages(spark, given, tmp_path):
    """The whole pipeline against the operators' decisions worked out on the driver."""
    import corpus_pipeline
    rows = {r["doc_id"]: r for r in given.collect()}
    bench = [decontaminate.normalise(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    prints = {i: _brute_fingerprint(r["text"]) for i, r in rows.items()}
    kept = [i for i in sorted(rows) if not any((prints[i] ^ prints[j]).bit_count() <= 3 for j in range(i) if j in prints)]
    kept = [i for i in kept if not any(b in decontaminate.normalise(rows[i]["text"]) for b in bench)]
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == set(kept)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmark", "secrets", "packing"]
    assert given.columns == corpus_pipeline.secrets(spark, given, SF).columns
