"""Merkle manifest, repeated passages and conversation repair against brute force, on small tables with every odd case."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle, repair, repeats

DOCS = "doc_id long, text string, lang string, source string, n_chars long, place long, known boolean, digest string, name string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMPTY = hashlib.sha256(b"").hexdigest()


def _doc(i, text, source="s", lang="en"):
    return (i, text, lang, source, None if text is None else len(text), 7, False, "x", "y")


# ---- manifest

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_h(*below[i:i + 16]) for i in range(0, len(below), 16)])
    return levels


def _climb(levels, at, digest, siblings):
    for below in levels[:-1]:
        run = below[at - at % 16:at - at % 16 + 16]
        siblings += run[:at % 16] + run[at % 16 + 1:]
        digest = _h(*run[:at % 16], digest, *run[at % 16 + 1:])
        at //= 16
    return digest


def _manifest(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for source in order:
        by_source[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
    trees = {s: _levels([_leaf(r) for r in by_source[s]]) for s in order}
    top, found = _levels([trees[s][-1][0] for s in order]), []
    for k, source in enumerate(order):
        for at, row in enumerate(by_source[source]):
            after, siblings = row, []
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                after = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            digest = _climb(top, k, _climb(trees[source], at, _leaf(after), siblings), siblings)
            found.append((row[0], _leaf(row), trees[source][-1][0], top[-1][0], _h(*siblings), digest, digest == top[-1][0]))
    return found


@pytest.mark.parametrize("depth", [3, 1])
def test_manifest(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "GROUP", 16 ** depth)
    rows = [_doc(i, f"Text No {i} ÄÖ", "big") for i in range(600)]
    rows += [_doc(i, f"Small {i}", f"s{i % 40}", None) for i in range(1000, 1060)]
    rows += [_doc(2000, "x" * 100000 + "A", "zürich"), _doc(2001, None, "zürich"), _doc(2002, "", "ZZ"), _doc(2003, "Lone", None),
             _doc(None, "No Id", "big"), _doc(5, "Same Id", "big"), rows[3], rows[3], _doc(2004, "lower only", "")]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    want = _manifest([(r[0], r[3], r[2], r[4], r[1]) for r in rows])
    got = [tuple(r) for r in merkle.tamper_check(docs).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[6] for r in got} == {True, False}


def test_manifest_of_one_none_and_siblings(spark):
    one = spark.createDataFrame([_doc(1, "Aa")], DOCS)
    row = merkle.tamper_check(one).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == EMPTY
    assert merkle.tamper_check(one.limit(0)).count() == 0
    two = spark.createDataFrame([_doc(1, "a"), _doc(2, "b")], DOCS)
    leaves = two.select("doc_id", "source", merkle.record_digest([F.col(c) for c in merkle.FIELDS]).alias("leaf"),
                        F.lit(None).cast("string").alias("changed"))
    a, b = merkle.manifest(leaves, siblings=True).orderBy("doc_id").collect()
    assert (a["proof"], b["proof"]) == (b["leaf"], a["leaf"]) and a["folded_root"] == a["root"] == _h(a["leaf"], b["leaf"])


# ---- repeated passages

def _without_copies(rows, k=13):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for p in range(len(w) - k + 1):
            if i is not None:
                key = tuple(w[p:p + k])
                first[key] = min(first.get(key, i), i)
    found = []
    for i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            if i is not None and first[tuple(w[p:p + k])] < i:
                gone[p:p + k] = [True] * k
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        found.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return found


def _corpus():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    some = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    passage, line = some(60), some(13)
    rows = [(i, some(rnd.randint(1, 120))) for i in range(60)]
    rows += [(100 + i, f"{some(rnd.randint(0, 30))} {passage}\n{some(rnd.randint(0, 20))}\t{line}") for i in range(40)]
    rows += [(200 + i, rows[60 + i % 10][1].replace(" w1", " v1", 2)) for i in range(20)]             # near copies
    rows += [(300 + i, rows[i][1]) for i in range(20)]                                                # exact copies
    rows += [(400, None), (401, ""), (402, " \n "), (403, "one"), (404, "é 日本語 " * 40), (405, "x " * 5000), (3, "x " * 300),
             (406, " ".join(rows[k][1] for k in range(60, 90))), (407, "a" * 50000), (None, passage), (None, None),
             (408, passage), (408, line + " " + passage), (408, passage), (409, line.replace(" ", "  \x0b")), (410, line[:-1]),
             (2, passage + " tail"), (411, " ".join(line.split()) + " " + line)]
    return rows


@pytest.mark.parametrize("share", [repeats.HOT_SHARE, 0.0])
def test_drop_copied(spark, monkeypatch, share):
    if not share:                                       # every document is sampled, and all but a few anchors are hot
        monkeypatch.setattr(repeats, "HOT_SAMPLE", 1)
        monkeypatch.setattr(repeats, "HOT_SHARE", 0.0)
        monkeypatch.setattr(repeats, "BIN", 8)
        monkeypatch.setattr(repeats, "RUN", 3)
        monkeypatch.setattr(repeats, "SLICE", 64)
    rows = _corpus()
    docs = spark.createDataFrame([_doc(i, t) for i, t in rows], DOCS).withColumn("t", F.lit(9)).withColumn("copy", F.lit("c")).repartition(4)
    got = [tuple(r) for r in repeats.drop_copied(docs).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(_without_copies(rows), key=key)
    assert repeats.drop_copied(docs.limit(0)).count() == 0


def test_hot_anchors_are_found_and_paths_are_compact(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_SAMPLE", 1)
    docs = spark.createDataFrame([_doc(i, t) for i, t in _corpus()], DOCS)
    texts = repeats._marked(docs).where("not copy and doc_id is not null and text is not null")
    assert len(repeats._hot_anchors(texts, 13, 4)) > 5
    fragments = repeats._shared(texts, 13, 4)
    paths = repeats._paths(fragments)
    edges = fragments.where("nodes is not null").agg(F.sum("n")).first()[0]
    assert paths.agg(F.sum("length")).first()[0] == edges and paths.count() < edges / 5
    assert paths.where("length < 1").count() == 0


def test_pieces_that_differ_from_their_source_are_kept(spark):
    words = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, 0, words), (2, 0, words)], "doc_id long, t long, text string")
    pieces = spark.createDataFrame([(2, 0, 0, 1, 0, 0, 3), (2, 0, 0, 1, 0, 1, 3)],
                                   "doc_id long, t long, pos long, from_doc long, from_t long, from_pos long, n long")
    assert [r["from_pos"] for r in repeats._verified(docs, pieces, 13).collect()] == [0]


def test_kept_text(spark):
    line = " ".join(f"w{i}" for i in range(13))
    docs = spark.createDataFrame([(1, line), (2, f"before {line} after"), (3, line.upper())], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in repeats.drop_copied(docs, keep_text=True).collect()} == {
        1: line, 2: "before after", 3: line.upper()}


# ---- conversations

def _damaged(conv, rows):
    found = []
    for turn, role, text in rows:
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        found += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return found


def _repair(conv, rows):
    """Dijkstra by (cost, edits)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).hexdigest()))
    turns, seen, faults = [r[0] for r in rows if r[0] is not None], set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    allowed = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "0", ())], set()
    while True:
        cost, path, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in "0a":
            break
        due = "a" if state == "u" else "u"
        name = "assistant" if due == "a" else "user"
        heapq.heappush(heap, (cost + 5, path + "I", i, due, (*lines, name + ":")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 2, path + "D", i + 1, state, lines))
            if faults[i] in ("", "t"):
                more = cost + (5 if faults[i] else 0)
                if (state, role[:1]) in allowed:
                    heapq.heappush(heap, (more, path + "K", i + 1, allowed[state, role[:1]], (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (more + 1, path + "R", i + 1, due, (*lines, f"{name}:{text}")))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, path,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _conversations():
    rnd, found = random.Random(5), {}
    texts = ["Yes.", "No!", "Why?", "cut off", "cut\n", "", " \t", "Fine. \n", None, "long " * 3000 + ".", "a.b"]
    for conv in [*range(150), None]:
        n = rnd.randint(1, 9)
        roles = ["system", "user", "assistant"] if conv is None or conv % 3 else ["user", "assistant", "tool", "", None, "useless"]
        turn = lambda k: None if rnd.random() < 0.1 else k * rnd.choice([1, 1, 1, 2])
        found[conv] = [(turn(k), rnd.choice(roles), rnd.choice(texts)) for k in range(n)]
    found[500] = [(k, "user" if k % 2 else "assistant", f"Turn {k}" + "." * (k % 7 > 0)) for k in range(300)]
    found[501] = [(k, rnd.choice(["user", "assistant", "system"]), rnd.choice(texts[:5]) if k % 5 else f"Only {k}.") for k in range(200)]
    found[502] = [(k, "user", "Same.") for k in range(100)]
    found[503] = [(None, "user", "No turn."), (None, None, None)]
    return found


TURNS = "conv_id long, turn long, role string, text string, pos long, conv string, known string, edit string, head string"


@pytest.mark.parametrize("block, segment", [(64, 4096), (4, 16)])
def test_repair(spark, monkeypatch, block, segment):
    monkeypatch.setattr(repair, "BLOCK", block)
    monkeypatch.setattr(repair, "SEGMENT", segment)
    given = _conversations()
    rows = spark.createDataFrame([(c, *r, 1, "x", "y", "z", "h") for c, rs in given.items() for r in rs], TURNS).repartition(3)
    key = lambda r: str(r[0])
    got = sorted([tuple(r) for r in repair.damaged_audit(rows).collect()], key=key)
    assert got == sorted([_repair(c, _damaged(c, rs)) for c, rs in given.items()], key=key)
    lines = repair.repaired(repair.damage(rows)).where("conv_id = 501").orderBy("place").collect()
    whole = "\n".join(f"{r['role']}:{r['text']}" for r in lines)
    assert [hashlib.sha256(whole.encode()).hexdigest()] == [r[8] for r in got if r[0] == 501]
    assert [r["place"] for r in lines] == list(range(len(lines)))


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], TURNS)
    assert repair.damaged_audit(none).count() == 0 and repair.repaired(none).count() == 0
    named = spark.createDataFrame([(9,)], "conv_id long")
    assert [tuple(r) for r in repair.audit(none, named).collect()] == [(9, 0, 0, 0, 0, 0, 0, "", EMPTY)]


def test_search_is_least_and_first():
    rnd = random.Random(2)
    for _ in range(300):
        codes = "".join(rnd.choice("suaoSUAOx") for _ in range(rnd.randint(1, 12)))
        cost, edits = repair._search(codes, 0, repair._FINAL, True)
        rows = [(k, {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}[c.lower()],
                 "" if c == "x" else f"{k} cut" if c.isupper() else f"{k}.") for k, c in enumerate(codes)]
        assert (cost, edits) == _repair(0, rows)[6:8]
