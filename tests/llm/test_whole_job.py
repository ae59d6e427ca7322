"""The corpus operators do the whole job: cases that a part of it would let through."""

import base64
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann, decontaminate, langid, ngram_lm, queries, secret_ledger, simhash

SF = "/root/testdata/sf0.001"

ALIEN = {
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "zh": "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
          "i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa i wolności.",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja "
          "heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "base64": base64.b64encode(random.Random(0).randbytes(600)).decode(),
    "gibberish": " ".join("".join(random.Random(i).choices("qxzwkvjybtr", k=6)) for i in range(60)),
    "run": "x" * 500,
}


def test_unlearned_languages_go_and_all_others_stay(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(10_000_000 + i, t) for i, t in enumerate(ALIEN.values())] + [(None, ALIEN["pl"]), (None, "1234 !")]
    rows += [(None, "The and attion to the ndand of the in that."), (10_000_000, "That it.")]     # a null id, an id that a rejected text has too
    more = given.limit(0).unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    kept = langid.keep_known(given.unionByName(more))
    assert kept.columns == given.columns
    kept = kept.collect()
    new = sorted(r["text"] for r in kept if r["doc_id"] is None or r["doc_id"] >= 10_000_000)
    assert new == ["That it.", "The and attion to the ndand of the in that."]
    assert len(kept) - 2 == given.count()


PROSE = {
    "en": "The quick growth of cities during the nineteenth century changed how people lived, worked and travelled. Railways carried "
          "goods and passengers further than ever before, while factories drew families away from farms. Public health suffered "
          "until engineers built sewers and clean water supplies.",
    "es": "Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben "
          "comportarse fraternalmente los unos con los otros.",
    "de": "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen "
          "einander im Geist der Brüderlichkeit begegnen.",
    "fr": "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et "
          "doivent agir les uns envers les autres dans un esprit de fraternité.",
}


def test_long_texts_and_prose_stay(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")      # enough for a whole learning sample
    by = {lang: " ".join(r["text"] for r in given.where((F.col("lang") == lang) & F.col("text").isNotNull()).collect()) for lang in PROSE}
    long = {lang: (t * (1 + 10_000_000 // len(t)))[:10_000_000] for lang, t in by.items()}
    rows = [(None, t) for t in [*PROSE.values(), *long.values(), *by.values(), long["en"], None, "", "  ", (ALIEN["pl"] + " ") * 3000]]
    more = given.limit(0).unionByName(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), allowMissingColumns=True)
    kept = [r["text"] for r in langid.keep_known(given.unionByName(more)).where("doc_id is null").collect()]
    assert sorted(map(hash, kept)) == sorted(map(hash, [*PROSE.values(), *long.values(), *by.values(), long["en"]]))


def test_shares_equal_counting_by_hand(monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 7)
    texts, labels = ["abc abd, abc", "bcd bcd abd", "xyz xyy", "zzy xyz"], ["a", "a", "x", "x"]
    model = langid.fit(texts, labels)
    known = langid.know(model, texts, labels)

    def grams(t, n):
        codes = "_" + "".join(c if c.isalpha() else "_" for c in t)
        while "__" in codes:
            codes = codes.replace("__", "_")
        return [codes[i:i + n] for i in range(len(codes) - n + 1)]
    for t in ["abc xyz abc", "abd bcd qqq abc abd", "xyz", "bc xyz zzy zz", "zzyzzyzzy.", "a", "xy"]:
        _, _, (share,) = langid._judge(model, langid.Grams(model.letters, known.grams), [t], known.owned)
        n = min(3, len(grams(t, 1)))
        has = [{g for s, lab in zip(texts, labels) if lab == lang for g in grams(s, n)} for lang in "ax"]
        assert abs(share - max(sum(g in h for g in grams(t, n)) for h in has) / len(grams(t, n))) < 1e-12, t


def test_a_small_learning_sample_lowers_the_share(spark):
    few = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("lang") == "en").orderBy("doc_id").limit(6)
    assert langid.keep_known(few).count() == 6


def _with_labels(spark, given, rows):
    """``given`` and rows of (doc_id, text, lang)."""
    return given.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string"), allowMissingColumns=True)


def test_a_language_of_held_out_rows_alone_is_learned(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    held = [i for i in range(20_000_000, 20_000_100) if zlib.crc32(str(i).encode()) % 3 == 1]
    polish = [ALIEN["pl"], ALIEN["pl"][:100], ALIEN["pl"][100:]]
    rows = [(i, t, "pl") for i, t in zip(held, polish)] + [(held[5], ALIEN["ru"], "ru")]
    aliens = [(None, t, None) for lang, t in ALIEN.items() if lang not in ("pl", "ru")]
    kept = langid.keep_known(_with_labels(spark, given, rows + aliens)).where("doc_id is null or doc_id >= 20000000").collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted(r[:2] for r in rows)


def test_few_texts_of_other_languages_let_nothing_else_in(spark):
    given, rnd = spark.read.parquet(f"{SF}/documents.parquet"), random.Random(6)
    learned = (i for i in range(20_000_000, 20_001_000) if zlib.crc32(str(i).encode()) % 3 != 1)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randint(3, 8)))
    lone = [" ".join(word(rnd.sample("bcdfghlmnprst", 4) + ["ö"]) for _ in range(40)) for _ in range(16)]
    unlike = ["abba " * 12, "cdöc " * 12]                                   # two texts of one language that know nothing of each other
    rows = [(next(learned), t, f"l{k}") for k, t in enumerate(lone)] + [(next(learned), t, "unlike") for t in unlike]
    aliens = [(None, t, None) for t in ALIEN.values()]
    kept = langid.keep_known(_with_labels(spark, given, rows + aliens)).collect()
    assert [r["text"][:30] for r in kept if r["doc_id"] is None] == []
    assert len(kept) == given.count() + len(rows)


def test_a_text_is_in_a_language_that_the_regression_finds_likely(spark):
    texts, labels = ["the cat and the dog", "the dog and a cat", "le chat et le chien", "le chien et un chat"], ["en", "en", "fr", "fr"]
    model = langid.fit(texts, labels)
    known = langid.know(model, texts, labels)
    grams = langid.Grams(model.letters, known.grams)
    no_share_needed, only_french = np.zeros(2), np.array([2.0, 0.0])
    assert langid._in_learned(model, grams, texts + ["", None, "12"], known.owned, no_share_needed).tolist() == [True] * 4 + [False] * 3
    assert langid._in_learned(model, grams, texts, known.owned, only_french).tolist() == [False, False, True, True]


def _pem(kind, lines, end=True, gap="\n", fields=""):
    rnd = random.Random(lines)
    body = base64.b64encode(rnd.randbytes(48 * lines + 20)).decode()
    parts = [f"-----BEGIN {kind}PRIVATE KEY-----", *fields.splitlines(), *(body[at:at + 64] for at in range(0, len(body), 64))]
    return gap.join(parts + [f"-----END {kind}PRIVATE KEY-----"] * end)


def test_no_line_of_a_private_key_stays(spark):
    fields = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF\n"
    keys = [_pem("RSA ", 25), _pem("", 3, gap="\\n"), _pem("OPENSSH ", 6, gap="\r\n"), _pem("EC ", 2, gap=" "), _pem("RSA ", 12, fields=fields),
            _pem("RSA ", 25, end=False), _pem("", 4, end=False, gap="\\n"), _pem("RSA ", 5, end=False, fields=fields),
            _pem("EC ", 2, end=False, gap="\n  > "), _pem("RSA ", 4000)]
    texts = [f"Keep this - it is text.\n{k}\nAnd this; - - - too." for k in keys]
    texts += [keys[0] + "\nbetween\n" + keys[5] + "\n\n" + keys[2], "starts with -----BEGIN PRIVATE KEY-----\nHello you", keys[5]]
    got = {r["doc_id"]: r["text"] for r in secret_ledger.redact(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i in range(len(keys)):
        assert got[i] == "Keep this - it is text.\n[SECRET]\nAnd this; - - - too.", keys[i][:80]
    assert [got[len(keys) + i] for i in range(3)] == ["[SECRET]\nbetween\n[SECRET]\n\n[SECRET]", "starts with [SECRET]\nHello you", "[SECRET]"]
    assert {(r.kind, r.version) for r in secret_ledger.RULES if r.kind == "pem"} == {("pem", 2)}       # ledgers of version 1 are scanned again


def _backoff(texts, order):
    """Sum of the logarithms of S, by its definition with all counts."""
    words = [(t or "").encode().lower().split() for t in texts]
    c = Counter(tuple(x[i:i + n]) for x in words for n in range(1, order + 1) for i in range(len(x) - n + 1))
    total = sum(map(len, words))

    def s(gram):
        if len(gram) == 1:
            return c[gram] / total
        return c[gram] / c[gram[:-1]] if c[gram] else 0.4 * s(gram[1:])
    return [sum(math.log(s(tuple(x[max(0, i - order + 1):i + 1]))) for i in range(len(x))) for x in words]


@pytest.mark.parametrize("order", [2, 3])
def test_no_count_is_left_out(spark, monkeypatch, order):
    monkeypatch.setattr(ngram_lm, "BLOCK_WORDS", 500)
    monkeypatch.setattr(ngram_lm, "HELD_BYTES", 1000)
    monkeypatch.setattr(ngram_lm, "HOT", 30)
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = [" ".join(rnd.choices(vocabulary, range(1, 41), k=rnd.randint(1, 50))) for _ in range(80)] + ["of the " * 300] * 2
    texts += [None, "", " ", "w1", "once", "two words", "W1 w2", "only here three", "of the", "of", "the of the end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in ngram_lm.score(df, order=order, least=1).collect()}
    for i, want in enumerate(_backoff(texts, order)):
        assert abs(got[i]["log_score"] - want) < 1e-5 and got[i]["n_words"] == len((texts[i] or "").split()), texts[i]
    assert ngram_lm.score(df.limit(0), order=order, least=1).count() == 0


def _backoff_by_others(texts, held, order):
    """Scores of the held-out texts by counts of the others; a word without a count scores 0.4 / N."""
    words = [(t or "").encode().lower().split() for t in texts]
    counted = [x for x, h in zip(words, held) if not h]
    c = Counter(tuple(x[i:i + n]) for x in counted for n in range(1, order + 1) for i in range(len(x) - n + 1))
    total = sum(map(len, counted))

    def s(gram):
        if len(gram) == 1:
            return max(c[gram], 0.4) / max(total, 1)
        return c[gram] / c[gram[:-1]] if c[gram] else 0.4 * s(gram[1:])
    return [sum(math.log(s(tuple(x[max(0, i - order + 1):i + 1]))) for i in range(len(x))) if h else None for x, h in zip(words, held)]


@pytest.mark.parametrize("hot", [30, 1000000])
@pytest.mark.parametrize("order", [2, 3])
def test_held_out_texts_back_off(spark, monkeypatch, order, hot):
    monkeypatch.setattr(ngram_lm, "BLOCK_WORDS", 500)
    monkeypatch.setattr(ngram_lm, "HOT", hot)
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choices(vocabulary, range(1, 61), k=rnd.randint(1, 40))) for _ in range(90)] + ["of the " * 300] * 2
    texts += [None, "", " ", "w1", "once", "two words", "W1 w2", "only here three", "of the", "of", "the of the end", "w3 new w5 w6", "w2 once w2 once"]
    held = [i % 3 == 0 or i > 91 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, h or None) for i, (t, h) in enumerate(zip(texts, held))], "doc_id long, text string, h boolean").repartition(3)
    got = {r["doc_id"]: r for r in ngram_lm.score(df, order=order, least=1, held_out=F.col("h")).collect()}
    for i, (want, every) in enumerate(zip(_backoff_by_others(texts, held, order), _backoff(texts, order))):
        assert abs(got[i]["log_score"] - every) < 1e-5 and got[i]["held_out"] == held[i], texts[i]
        assert got[i]["held_out_log_score"] is None if want is None else abs(got[i]["held_out_log_score"] - want) < 1e-5, texts[i]
    alone = ngram_lm.score(df.where("doc_id = 99"), order=order, least=1, held_out=F.lit(True)).first()
    assert abs(alone["held_out_log_score"] - _backoff_by_others([texts[99]], [True], order)[0]) < 1e-5


@pytest.mark.parametrize("hot", [30, 1000000])
@pytest.mark.parametrize("order", [2, 3])
def test_slices_of_a_bucket_give_the_same_scores(spark, monkeypatch, order, hot):
    for name, few in {"BLOCK_WORDS": 700, "HOT": hot, "SLICE_PAIRS": 60, "PENDING_NEEDS": 25, "PENDING_BYTES": 900, "PIECE_BYTES": 80}.items():
        monkeypatch.setattr(ngram_lm, name, few)
    rnd = random.Random(11)
    vocabulary = [f"w{i}" * (1 + i % 9) for i in range(70)]
    texts = [" ".join(rnd.choices(vocabulary, range(1, 71), k=rnd.randint(1, 60))) for _ in range(100)]
    texts += [None, "", "w1", "of the " * 200, "of the " * 200, "new words here", "x" * 200 + " " + "x" * 201]
    held = [i % 4 == 0 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, h) for i, (t, h) in enumerate(zip(texts, held))], "doc_id long, text string, h boolean").repartition(3)
    got = {r["doc_id"]: r for r in ngram_lm.score(df, order=order, least=1, held_out=F.col("h")).collect()}
    for i, (want, every) in enumerate(zip(_backoff_by_others(texts, held, order), _backoff(texts, order))):
        assert abs(got[i]["log_score"] - every) < 1e-5 and got[i]["n_words"] == len((texts[i] or "").split()), texts[i]
        assert got[i]["held_out_log_score"] is None if want is None else abs(got[i]["held_out_log_score"] - want) < 1e-5, texts[i]


def test_words_are_hashed_as_they_are_split():
    rnd = random.Random(12)
    odd = [b"", b"  ", b"\t\n", b"a\x00", b"a", b"A\x0bb\x0cC\rd", "É é Ü\u00a0x \u2003".encode(), b"end", b"start end ", b" x" * 50]
    for n in (1, 7, 8, 9, 15, 16, 17, 63, 64, 65, 72, 200):
        odd += [b"x" * n, b"X" * n + b" " + b"x" * (n - 1) + b"y", b"y" + b"x" * (n - 1)]
    texts = odd + [b"".join(rnd.choices([b" ", b"a", b"B", b"\n", b"\xc3\xa9", b"word", b"\x00"], k=40)) for _ in range(500)] + [None]
    seen = {}
    for lo in (0, 1, 5):
        column = pa.array(texts, pa.binary())[lo:]
        hashes, n = ngram_lm._word_hashes(column.fill_null(b""))
        words = [w for t in texts[lo:] for w in (t or b"").lower().split()]
        assert n.tolist() == [len((t or b"").lower().split()) for t in texts[lo:]] and len(hashes) == len(words)
        for w, h in zip(words, hashes.tolist()):
            assert seen.setdefault(w, h) == h and 2 <= h < 1 << 48
    assert len(set(seen.values())) == len(seen)


def test_a_bucket_takes_little_room(spark):
    """Rows of a full bucket (8 MB of text), and what a task needs to score them."""
    rnd = np.random.default_rng(13)
    words = np.array([f"word{i}" for i in range(30000)])
    texts = [" ".join(words[(30000 * rnd.random(500) ** 3).astype(int)]) for _ in range(2000)]
    n, none, counts = 1_000_000, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    df = spark.createDataFrame([(i, t, i % 20 == 0) for i, t in enumerate(texts)], "doc_id long, text string, held boolean").coalesce(2)
    rows = ngram_lm.pair_blocks(df, none, 1, 3).toArrow()
    assert rows.num_rows >= 2 and rows.nbytes < 15 * n, rows.nbytes / n
    batches = rows.to_batches()
    tracemalloc.start()
    out = [(b["kind"].to_pylist(), b.nbytes) for b in ngram_lm._pair_scores(103, none, counts, counts, 1, n, n * 19 // 20, 3)(iter(batches))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 * n, peak / n
    assert sum(len(kinds) for kinds, _ in out) < 1000                       # one row for each bucket and kind, not for each block


def test_registered_query_backs_off(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r["held_out_log_score"] for r in queries.op4_backoff_lm(spark, SF).collect()}
    want = _backoff_by_others([r["text"] for r in rows], [r["doc_id"] % 20 == 0 for r in rows], 3)
    assert all(got[r["doc_id"]] is None if s is None else abs(got[r["doc_id"]] - s) < 1e-4 for r, s in zip(rows, want, strict=True))


def test_registered_scores_are_of_trigrams_with_all_counts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r["log_score"] for r in queries.op4_backoff_lm(spark, SF).collect()}
    assert all(abs(got[r["doc_id"]] - s) < 1e-4 for r, s in zip(rows, _backoff([r["text"] for r in rows], 3), strict=True))


SPECIAL = ["hi <|endoftext|> there", "<|endoftext|>", "a<|endoftext|>b", "x  <|endoftext|>\n\n y", "<|endoftext|><|startoftext|> One, two. ",
           " <|endoftext|> ", "<|ENDOFTEXT|> no", "<|endof text|> no", "word " * 300 + "<|endoftext|>" + " word" * 300, "plain words, no token"]


@pytest.mark.parametrize("name,make", [("byte_bpe_50k.json", queries.byte_encoder), ("word_bpe_49k.json", queries.word_encoder)])
def test_registered_encoders_equal_the_unmodified_library(name, make):
    import public_tokenizers
    from tokenizers import Tokenizer
    library, mine, rnd = Tokenizer.from_file(public_tokenizers.path(name)), make()(), random.Random(6)
    odd = ["".join(rnd.choice([" ", "\n", "a", "B", "é", ".", "\t", "<|endoftext|>", "<|startoftext|>", "<|"]) for _ in range(15)) for _ in range(2000)]
    for t in SPECIAL + odd:
        assert np.frombuffer(mine(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_decisions_go_with_the_row_and_not_with_its_id(spark):
    rnd = random.Random(8)
    alone = [" ".join(f"{rnd.choice('abcdefgh')}{rnd.randint(0, 999)}" for _ in range(40)) for _ in range(6)]
    item = alone[5]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, f"x {item} y"), (None, alone[0]), (7, f"x {item} y"), (7, alone[1]), (7, None), (8, item)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in decontaminate.remove(df, bench).collect()]
    assert sorted(kept, key=str) == sorted([rows[1], rows[3], rows[4]], key=str)
    got = sorted((str(r["doc_id"]), r["contaminated"], r["item_ids"]) for r in decontaminate.report(df, bench).collect())
    assert got == sorted((str(i), item in (t or ""), [1] * (item in (t or ""))) for i, t in rows)

    rows = [(3, alone[0]), (5, alone[1]), (5, alone[0]), (None, alone[0]), (None, alone[2]), (None, alone[2]), (9, alone[3]), (9, alone[4]), (9, alone[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, simhash.keep_one(df).collect()), key=str) == sorted(
        [rows[0], rows[1], rows[4], rows[6], rows[7]], key=str)


def test_isolated_vectors_beside_tight_clusters_find_their_neighbours(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 24))
    x = np.concatenate([c + 1e-5 * rng.normal(size=(40, 24)) for c in centres] + [rng.normal(size=(60, 24))])
    x = (x / np.linalg.norm(x, axis=1)[:, None])[rng.permutation(len(x))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in ann.search(df, every=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert sorted(got) == list(range(0, len(x), 5)) and all(sorted(n for n, _ in g) == list(range(1, 21)) for g in got.values())
    few = ann.search(df.where("vec_id < 8"), every=1).collect()
    assert len(few) == 8 * 7 and all(abs(r["score"] - float(x[r["query_id"]] @ x[r["vec_id"]])) < 1e-12 for r in few)


def test_stages_leave_columns_named_like_their_own_alone(spark):
    from tessera.llm import decontaminate, secret_ledger, simhash
    item = "What is the boiling point of water at the level of the sea in degrees?"
    texts = ["alpha beta gamma delta epsilon zeta eta", "alpha beta gamma delta epsilon zeta eta", f"so: {item} indeed",
             "password = hunter2secret and the rest", None]
    own = ["_row", "_ROW_", "_text", "_hit", "_b", "_blob", "_spans", "_stay", "blob", "spans", "fp", "root"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, *[f"{c}{i}" for c in own]) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in own))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")

    def extras(df):
        assert df.columns == docs.columns
        return {r["doc_id"]: tuple(r[c] for c in own) for r in df.collect()}
    given = extras(docs)
    assert extras(simhash.keep_one(docs)) == {i: x for i, x in given.items() if i != 1}
    assert extras(decontaminate.remove(docs, bench)) == {i: x for i, x in given.items() if i != 2}
    clean = secret_ledger.redact(docs)
    assert extras(clean) == given and "hunter2secret" not in clean.where("doc_id = 3").first()["text"]


def test_later_stages_do_not_see_what_the_language_stage_drops(spark, tmp_path):
    import corpus_pipeline
    given = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame([(None, t) for t in ALIEN.values()] + [(None, None), (None, "123 456")], "doc_id long, text string")
    docs = given.select("doc_id", "text", "lang").unionByName(more.selectExpr("doc_id", "text", "cast(null as string) lang"))
    corpus_pipeline.STAGES[0][1](spark, docs, SF).write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    packed = corpus_pipeline.pack(spark, kept, SF)
    assert kept.count() == given.count() < docs.count()
    assert packed.where("doc_id is null").count() == 0 and corpus_pipeline.pack(spark, docs, SF).where("doc_id is null").count() > 0
