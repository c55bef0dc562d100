"""Corpus operators on texts against plain reference code, with null, empty, long, tied and repeated rows."""

import hashlib
import random
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tickloom.llm import decontam, langid, neardup, piece, quality, queries, secretscan, substrdup, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, ids=None, lang="en"):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t in zip(ids, texts)], DOCS)


def clashing(df):
    """The same rows with columns named like outputs and helpers."""
    return df.withColumns({c: F.lit("x") for c in ("score", "predicted", "n_tokens", "spans", "items", "kept", "component_id", "__text", "rep", "node", "count", "y", "held_out")})


WORDS = "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were her all she there would their".split()


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", ".", ","]) for _ in range(n))


# --- sentencepiece ----------------------------------------------------------------------------------------------------


def test_piece_equals_library(spark):
    import sentencepiece

    path = queries.piece_model()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rnd = random.Random(3)
    alphabet = [chr(c) for c in range(32, 127)] + list("▁▁  éñüß\n\t日本語ａ😀​\x00") + ["the", "ing", " th", "   ", "aaaa", "====", "abab"]
    texts = [None, "", " ", "▁", "\x00", "a" * 5000, " " * 300, "=-" * 3000, "x" + "日" * 400, *["".join(rnd.choices(alphabet, k=rnd.randrange(70))) for _ in range(1500)]]
    got = {r.doc_id: r for r in piece.tokenize(frame(spark, texts), path, ["doc_id"], decoded="decoded", digests=True).collect()}
    for i, t in enumerate(texts):
        want = sp.encode(t or "", add_bos=True, add_eos=True)
        assert got[i].ids == want and got[i].n_tokens == len(want)
        assert got[i].decoded == sp.decode(want)
        assert got[i].ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in want)).hexdigest()
    ids = [[rnd.randrange(32000) for _ in range(30)] for _ in range(300)]
    assert [piece.decode(x, path) for x in ids] == [sp.decode(x) for x in ids]
    assert piece.tokenize(frame(spark, []), path, ["doc_id"]).count() == 0
    out = piece.tokenize(clashing(frame(spark, ["a b"])), path, ["doc_id", "n_tokens", "score"])
    assert out.first().n_tokens == 4 and out.columns.count("n_tokens") == 1


def test_long_words_equal_library():
    import time

    import sentencepiece

    path = queries.piece_model()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rnd = random.Random(31)
    pieces = [sp.id_to_piece(i) for i in range(300, sp.get_piece_size()) if sp.id_to_piece(i).isalpha()]
    texts = []
    for _ in range(150):
        n = rnd.randrange(65, 900)
        texts.append("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=n)))
        texts.append("".join(rnd.choices("etaoinsrh", k=n)))
        texts.append("".join(rnd.choices(pieces, k=n // 4)))
        unit = "".join(rnd.choices("=-_ae▁hst", k=rnd.randrange(1, 12)))
        texts.append(unit * (n // len(unit)) + rnd.choice(["", "x", "th", unit[:1]]))
        texts.append("".join(rnd.choice("ab=") * rnd.randrange(1, 40) for _ in range(20)))
    got = piece.encode(texts, path)
    assert all(g.tolist() == sp.encode(t, add_bos=True, add_eos=True) for g, t in zip(got, texts))
    for make in (lambda n: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=n)), lambda n: "thequickbrownfox" * (n // 16), lambda n: "a" * n, lambda n: "haas=-" * (n // 6)):
        text = make(1_000_000)
        before = time.monotonic()
        ids = piece.encode([text], path)[0].tolist()
        took = time.monotonic() - before
        assert ids == sp.encode(text, add_bos=True, add_eos=True) and took < 10, took


# --- decontamination --------------------------------------------------------------------------------------------------

DW = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def dwords(t):
    return DW.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def decontam_brute(docs, items):
    windows = {}
    for i, t in items:
        w = dwords(t)
        k = min(13, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[j : j + k]), set()).update([] if i is None else [str(i)])
    out = {}
    for d, t in docs:
        w, hit, found = dwords(t), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if (s := windows.get(tuple(w[j : j + k]))) is not None:
                    hit |= set(range(j, j + k))
                    found |= s
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("limit", [1 << 20, 400])
def test_decontamination(spark, limit):
    rnd = random.Random(5)
    items = [(i, prose(rnd, rnd.choice([3, 12, 13, 20, 40]))) for i in range(12)] + [(50, None), (51, ""), (52, "!!! ..."), (53, "Élan ünd 日本 x9"), (3, "again one two three"), (None, "alpha beta gamma"), (None, prose(rnd, 30))]
    texts = [None, "", "...", "x " * 3000]
    for k in range(40):
        t = prose(rnd, rnd.randrange(1, 200))
        if k % 2:
            t += " " + rnd.choice(items[:12])[1].upper() + "!" + prose(rnd, rnd.randrange(300))
        texts.append(t)
    texts += [texts[5], "élan ÜND 日本 x9", "Élan ünd 日本 x9", "alpha Beta gamma", "x " + items[-1][1]]
    docs = clashing(frame(spark, texts))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in decontam.digest(decontam.find_hits(docs, bench, ["doc_id"], broadcast_bytes=limit)).collect()}
    assert got == decontam_brute(enumerate(texts), items)
    assert decontam.find_hits(docs, bench.where("false"), ["doc_id"]).where("size(spans) > 0").count() == 0
    assert decontam.find_hits(docs.unionByName(docs), bench, ["doc_id", "n_words"], broadcast_bytes=limit).count() == 2 * len(texts)
    spans = decontam.find_hits(docs, bench, ["doc_id", "text"], broadcast_bytes=limit).where("size(spans) > 0").collect()
    for r in spans:
        raw = r.text.encode()
        assert all(len(dwords(raw[s.from_byte : s.to_byte].decode())) == s.end - s.first for s in r.spans)


# --- secrets ----------------------------------------------------------------------------------------------------------

ASSIGN = re.compile("((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def base_spans(t):
    s = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    s += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    s += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(s))


def test_secrets(spark):
    rnd = random.Random(9)
    parts = ["password", "Secret", "token=", " : ", "= ", "api_key", "APIKEY", "\"", "'", "AKIA", "AKIAAKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", " ", "é", "😀", "\n", "x", "abc", "tOkEn", "aB3xK9_qZ7", "="]
    texts = [None, "", "secret=token: abcdefg", "password = 'abcdef'", "password" * 3000, "token=abcdef " * 900, "f" * 5000, "AKIA" * 40, *["".join(rnd.choices(parts, k=rnd.randrange(40))) for _ in range(400)]]
    texts += [f"hello qX7{rnd.randbytes(14).hex().upper()}zK there" for _ in range(5)] + [texts[9], "plain words and ordinary_identifier_names2 here " * 30]
    docs = clashing(frame(spark, texts))
    got = {r.doc_id: r for r in secretscan.digest(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = base_spans(t or "")
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (t, want)
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [len(re.findall(k + ":", want)) for k in ("assign", "access", "hex")]
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("markov")] == [s for s in want.split(",") if s]
    model = secretscan.train(docs)
    clean = {r.doc_id: r.text for r in secretscan.redact(docs, model).collect()}
    assert clean[0] is None and clean[1] == "" and clean[3] == "[SECRET]'" and clean[len(texts) - 1] == texts[-1]
    assert secretscan.redact(docs, model).columns == docs.columns
    assert secretscan.digest(docs.where("false")).count() == 0


def test_markov_spans(spark):
    rnd = random.Random(12)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    odd = ["".join(rnd.choices(letters, k=24)) for _ in range(10)] + [rnd.randbytes(14).hex().upper() for _ in range(5)]
    plain = ["ordinary_identifier_names2", "getCustomerOrderHistory2024", "there-would-have-been-2-of-them", "wouldtheybeherewithherthen1"]
    names = "getItemList userName3 setOrderId HistoryEntry2023 loadCustomer page2024 OrderHistory newCustomerName fooBar12".split()
    texts = [prose(rnd, 120) + f" password={rnd.randbytes(9).hex()} " + " ".join(rnd.choices(names, k=9)) for _ in range(60)] + [f"hello {w} there" for w in odd + plain]
    got = {r.doc_id: r.spans for r in secretscan.digest(frame(spark, texts)).collect()}
    assert sum(got[60 + i] == f"markov:6:{6 + len(w)}" for i, w in enumerate(odd)) >= 14
    assert all(got[60 + len(odd) + i] == "" for i in range(len(plain)))


def markov_brute(texts, ratios):
    """All spans of each text by plain code, from the ratios of the trained models."""
    code = {c: i + 1 for i, c in enumerate(secretscan.SYMBOLS)}
    ratios = [float(f"{x:.5f}") for x in ratios]
    out = []
    for t in texts:
        t = t or ""
        base = [(int(a), "assign access hex".split().index(k), int(b), k) for k, a, b in (x.split(":") for x in base_spans(t).split(",") if x)]
        more = []
        for m in re.finditer("(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", t):
            c = [code.get(x, 0) for x in m[0]]
            odd = sum(ratios[a * secretscan.SIDE + b] for a, b in zip(c, c[1:])) / len(c)
            if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and odd > secretscan.LIMIT and not any(a < m.end() and m.start() < e for a, _, e, _ in base):
                more.append((m.start(), 3, m.end(), "markov"))
        out.append(sorted(base + more))
    return out


def models_brute(texts):
    """The trained ratios by plain counting, where all documents are ordinary ones."""
    import math

    code = {c: i + 1 for i, c in enumerate(secretscan.SYMBOLS)}
    random_, ordinary = [], []
    for t in texts:
        t = t or ""
        random_ += [m[2] for m in ASSIGN.finditer(t) if len(m[2]) >= 12] + re.findall("AKIA[A-Z0-9]{16,}", t) + re.findall("(?<![0-9a-f])[0-9a-f]{24,}", t)
        ordinary += re.findall("[A-Za-z0-9_]{4,}", re.sub("(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", " ", ASSIGN.sub(" ", t)))
    logs, side, n = [], secretscan.SIDE, len(secretscan.SYMBOLS)
    for words, uniform, weight in ((random_ + [w.upper() for w in random_], 0.3, 0.0), (ordinary, 0.02, 20.0)):
        counts = {}
        for w in words:
            for a, b in zip(w, w[1:]):
                a, b = code.get(a, 0), code.get(b, 0)
                counts[a, b] = counts.get((a, b), 0) + (b > 0)
        total = sum(v for (a, _), v in counts.items() if a)
        single = {b: (sum(counts.get((a, b), 0) for a in range(1, side)) + 1.0) / (total + n) for b in range(side)}
        rows = {a: sum(counts.get((a, b), 0) for b in range(side)) + weight for a in range(side)}
        logs.append([math.log((1 - uniform) * ((counts.get((a, b), 0) + weight * single[b]) / rows[a] if rows[a] else 1 / n) + uniform / n) if a and b else 0.0 for a in range(side) for b in range(side)])
    return [x - y for x, y in zip(*logs)]


def test_markov_spans_equal_plain_code(spark):
    rnd = random.Random(13)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
    texts = [None, "", *[" ".join(rnd.choice([rnd.choice(WORDS), "token=", "token: abc", "".join(rnd.choices(letters, k=rnd.randrange(8, 40))), rnd.randbytes(13).hex(), "password=" + "".join(rnd.choices(letters, k=30)), "é😀"]) for _ in range(rnd.randrange(30))) for _ in range(300)]]
    docs = clashing(frame(spark, texts))
    ratios = secretscan.train(docs)
    assert max(abs(a - b) for a, b in zip(ratios, models_brute(texts), strict=True)) < 1e-9
    want = markov_brute(texts, ratios)
    assert sum(k == 3 for w in want for _, k, _, _ in w) > 30
    got = {r.doc_id: r.spans for r in secretscan.digest(docs).collect()}
    assert got == {i: ",".join(f"{k}:{a}:{b}" for a, _, b, k in w) for i, w in enumerate(want)}
    clean = {r.doc_id: r.text for r in secretscan.redact(docs, ratios).collect()}
    for i, (t, w) in enumerate(zip(texts, want)):
        out, end = "", -1
        for a, _, b, _ in w:
            if a > end:
                out += t[max(end, 0) : a] + secretscan.MASK
            end = max(end, b)
        assert clean[i] == (t if not w else out + t[end:])


def test_very_many_secrets_in_one_text(spark):
    import time

    rnd = random.Random(14)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    text = " ".join("token=abcdef" if k % 2 else "a7" + "".join(rnd.choices(letters, k=22)) for k in range(100_000))
    ratios = [1.0] * secretscan.SIDE**2
    before = time.monotonic()
    clean = secretscan.redact(frame(spark, [text]), ratios).first().text
    assert clean == " ".join([secretscan.MASK] * 100_000) and time.monotonic() - before < 60


# --- trained classifiers ----------------------------------------------------------------------------------------------


def labelled(spark, make, n, label):
    rnd = random.Random(11)
    rows = [(i, *make(rnd, i)) for i in range(n)]
    docs = frame(spark, [t for _, t, _ in rows] + [None, "", "word", prose(rnd, 20_000)], [*[i for i, _, _ in rows], 10_000, 10_001, 10_002, 10_003])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (99_999, 0)], f"doc_id long, {label} int")
    return docs.unionByName(docs.where("doc_id = 0")), labels, {i: y for i, _, y in rows}


def accuracy(rows, truth):
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    return sum(r.predicted == truth[r.doc_id] for r in held) / len(held), len(held)


def test_quality(spark):
    def make(rnd, i):
        t = prose(rnd, rnd.randrange(40, 200))
        return (t, 1) if i % 4 else (t.upper().replace(" ", "!! ") if i % 8 else (rnd.choice(WORDS) + " ") * 120, 0)

    docs, labels, truth = labelled(spark, make, 400, "quality")
    rows = quality.digest(clashing(docs), labels).collect()
    assert len(rows) == 405 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    share, n = accuracy(rows, truth)
    assert n > 50 and share > 0.9
    assert {r.score for r in quality.digest(docs, labels.where("false")).collect()} == {0.5}
    assert quality.digest(docs.where("false"), labels).count() == 0


def test_toxicity(spark):
    def make(rnd, i):
        w = prose(rnd, rnd.randrange(30, 150)).split()
        if i % 5 == 0:
            for _ in range(rnd.randrange(1, 4)):
                w.insert(rnd.randrange(len(w)), rnd.choice(["vilexa", "vilexo", "vilexet", "grumbag"]))
        return " ".join(w), int(i % 5 == 0)

    docs, labels, truth = labelled(spark, make, 700, "toxic")
    rows = toxicity.digest(clashing(docs), labels).collect()
    assert len(rows) == 705 and all(0 <= r.score <= 1 and r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    share, n = accuracy(rows, truth)
    assert n > 100 and share > 0.95
    model = toxicity.fit(docs, labels)
    r = toxicity.score(frame(spark, ["the of Vilexu and to in"]), model, ["doc_id"]).first()
    assert [(s.from_byte, s.to_byte) for s in r.spans] == [(7, 13)] and r.predicted == 1
    assert toxicity.digest(docs.where("false"), labels).count() == 0
    assert len({r.score for r in toxicity.digest(docs, labels.where("false")).collect()}) == 1


def chain(sizes, weights):
    """Words of documents of the given sizes, and a run of the field over them."""
    import numpy as np

    emit, trans, start = weights
    words = toxicity._arrays([" ".join("w" for _ in range(n)) for n in sizes])
    chains = toxicity.Chains(words)
    fore, back, post, logz = chains.run(np.exp(emit), np.exp(trans), float(np.exp(start)))
    return post, logz, chains.pairs(fore, back, np.exp(trans), np.ones(len(emit)))


def test_crf_equals_enumeration():
    import itertools
    import math

    import numpy as np

    rnd = np.random.default_rng(1)
    for size in (1, 2, 5, 9):
        e, trans, start = rnd.normal(size=size), rnd.normal(size=(2, 2)), 0.3
        weight, total, pairs = np.zeros(size), 0.0, np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=size):
            w = math.exp(sum(e[i] for i in range(size) if tags[i]) + start * tags[0] + sum(trans[a, b] for a, b in itertools.pairwise(tags)))
            total += w
            weight += w * np.array(tags)
            for a, b in itertools.pairwise(tags):
                pairs[a, b] += w
        post, logz, found = chain([size], (e, trans, start))
        assert np.allclose(post, weight / total) and abs(logz[0] - math.log(total)) < 1e-9 and np.allclose(found, pairs / total)


def test_crf_runs_over_whole_documents():
    import numpy as np

    rnd = np.random.default_rng(2)
    sizes = [1000, 0, 63, 64, 65, 1, 128, 129, 4000]
    e, trans, start = rnd.normal(size=sum(sizes)), rnd.normal(size=(2, 2)), -0.4
    post, logz, _ = chain(sizes, (e, trans, start))
    at = 0
    for size, z in zip(sizes, logz):
        x, t = np.exp(e[at : at + size]), np.exp(trans)
        fore, back, total = np.zeros((size, 2)), np.ones((size, 2)), 0.0
        for i in range(size):
            a = np.array([1, np.exp(start)]) if not i else fore[i - 1] @ t
            a = a * [1, x[i]]
            total += np.log(a.sum())
            fore[i] = a / a.sum()
        for i in range(size - 2, -1, -1):
            b = t @ (back[i + 1] * [1, x[i + 1]])
            back[i] = b / b.sum()
        want = fore * back
        assert size == 0 or np.allclose(post[at : at + size], want[:, 1] / want.sum(1))
        assert abs(z - total) < 1e-8
        at += size


def test_toxicity_of_a_rare_language(spark):
    def make(rnd, i):
        rare = i % 12 == 0
        w = (prose(rnd, rnd.randrange(30, 150)).split() if not rare else [rnd.choice(["kalo", "mera", "tuni", "sopal", "rike"]) + rnd.choice(["s", "n", "", "ta"]) for _ in range(60)])
        bad = i % 60 == 0 if rare else i % 5 == 0
        for _ in range(rnd.randrange(1, 4) if bad else 0):
            w.insert(rnd.randrange(len(w)), "bomente" + rnd.choice(["co", "rr", "ja", "do", "li"]) if rare else rnd.choice(["vilexa", "grumbag"]))
        return " ".join(w), int(bad)

    docs, labels, truth = labelled(spark, make, 1800, "toxic")
    rows = {r.doc_id: r for r in toxicity.digest(docs, labels).collect()}
    rare = [i for i in range(0, 1800, 60) if rows[i].held_out]
    assert len(rare) >= 5 and sum(rows[i].predicted for i in rare) >= 0.9 * len(rare)
    clean = [i for i in range(0, 1800, 12) if i % 60 and rows[i].held_out]
    assert sum(rows[i].predicted for i in clean) <= 0.05 * len(clean) + 1


def test_language(spark):
    rnd = random.Random(2)
    words = {"aa": ["kalo", "mera", "tuni", "sopal", "rike"], "bb": ["schun", "gritz", "pfeln", "wortz", "krumb"], "cc": ["oué", "léau", "çair", "motre", "sieux"]}
    rows = []
    for i in range(360):
        k = "abc"[i % 3] * 2
        rows.append((i, " ".join(rnd.choice(words[k]) + rnd.choice(["", "s", "n"]) for _ in range(rnd.randrange(8, 60))), k, "s", 0))
    rows += [(1000, None, "aa", "s", 0), (1001, "", None, "s", 0), (1002, "123 !! 45", "bb", "s", 0), (1003, "kalo " * 30_000, None, "s", 0), (None, "mera tuni", None, "s", 0), (5, rows[5][1], rows[5][2], "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = langid.digest(clashing(docs).withColumn("lang_pred", F.lit(1))).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    held = [i for i in range(360) if crc32(str(i).encode()) % 3 == 1]
    assert all(by[i].held_out for i in held) and sum(by[i].lang_pred == "abc"[i % 3] * 2 for i in held) >= 0.97 * len(held)
    assert by[1000].lang_pred == by[1001].lang_pred == by[1002].lang_pred == "und" and by[1003].lang_pred == "aa"
    assert {r.lang_pred for r in langid.digest(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.digest(docs.where("false")).count() == 0


def plain_phrases(train, text):
    s = "".join(train)
    n, i = 0, 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in s:
            k += 1
        n, i = n + 1, i + k
    return n


@pytest.mark.parametrize("alphabet", [4, 900])
def test_phrases_equal_plain_parsing(alphabet, monkeypatch):
    rnd = random.Random(4)
    letters = [chr(0x4E00 + k) for k in range(alphabet)]
    train = "".join(rnd.choices(letters, k=3000))
    texts = ["".join(rnd.choices([*letters, "ж"], k=k)) for k in (0, 1, 2, 7, 8, 9, 100, 3000)]
    texts += [train[200:1900], (train[5:60] + "ж") * 9, train[:9] * 70, "".join(train[a : a + rnd.randrange(1, 40)] for a in rnd.choices(range(2900), k=90))]
    model = langid.train({"x": [train]})
    assert model.points.tolist() == sorted(map(ord, set(train)))
    for block, head in ((8, 3), (8, 8), (64, 16), (768, 192)):
        monkeypatch.setattr(langid, "BLOCK", block)
        monkeypatch.setattr(langid, "HEAD", head)
        import numpy as np

        points = np.array([ord(c) for t in texts for c in t])
        got = model.phrases(model.automata()[0][points], np.array([len(t) for t in texts]))[:, 0].tolist()
        assert got == [plain_phrases(train + "\0", t) for t in texts]


def test_language_choice_equals_plain_code():
    import math

    rnd = random.Random(15)
    words = {"aa": ["kalo", "mera", "tuni"], "bb": ["tunk", "merk", "kalk"]}
    make = lambda lang, n: " ".join(rnd.choice(words[lang]) for _ in range(n))
    sample = {k: [make(k, 40) for _ in range(5)] for k in words}
    model = langid.train(sample, 700)
    texts = [make(rnd.choice("ab") * 2, rnd.randrange(1, 30)) + rnd.choice(["", " ж", "!!", " mera"]) for _ in range(60)]
    got, score = model.predict([t.encode() for t in texts])
    for t, lang, s in zip(texts, got, score):
        fold = re.sub(r"[\W\d_]+", "\0", t.lower())
        rates = {}
        for k in sorted(sample):
            joined, used = "", 0
            for x in sample[k]:
                part = x.replace(" ", "\0") + "\0"
                if used and used + len(part) > 700:
                    break
                joined, used = joined + part, used + len(part)
            rates[k] = plain_phrases(joined, fold) * math.log2(len(joined)) / len(fold)
        best = min(rates, key=lambda k: (rates[k], k))
        assert lang == best and abs(s - 1 / sum(math.exp(-8 * (r - rates[best])) for r in rates.values())) < 1e-9


def test_large_scripts(spark):
    rnd = random.Random(16)
    scripts = {f"l{k}": [chr(0x61 + (3 * k + j) % 26) for j in range(12)] for k in range(5)}
    scripts |= {"zh": [chr(0x4E00 + j) for j in range(800)], "ja": [chr(0x4E00 + 400 + j) for j in range(800)], "emo": [chr(0x10400 + j) for j in range(40)]}
    rows = []
    for i in range(960):
        lang = sorted(scripts)[i % len(scripts)]
        vocabulary = random.Random(lang).choices(["".join(random.Random(f"{lang}{w}").choices(scripts[lang], k=2 + w % 3)) for w in range(400)], k=400)
        rows.append((i, " ".join(rnd.choice(vocabulary) for _ in range(40)), lang, "s", 0))
    got = {r.doc_id: r for r in langid.digest(spark.createDataFrame(rows, DOCS)).collect()}
    for lang in scripts:
        held = [i for i, _, k, _, _ in rows if k == lang and got[i].held_out]
        assert len(held) > 20 and sum(got[i].lang_pred == lang for i in held) >= 0.95 * len(held), lang


# --- near duplicates --------------------------------------------------------------------------------------------------

NW = re.compile("[^\\x20\\x09-\\x0D]+")


def shingles(t):
    w = NW.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= 85 * len(s | t):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: (len(s), root(i)) for i, s in sets}


def edited(rnd, t, rate):
    return " ".join(rnd.choice(WORDS) + "q" if rnd.random() < rate else w for w in t.split(" "))


@pytest.mark.parametrize(("chunk", "leaf"), [(600, 48), (6, 4)])
def test_near_duplicates(spark, chunk, leaf, monkeypatch):
    rnd = random.Random(21)
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    monkeypatch.setattr(neardup, "LEAF", leaf)
    monkeypatch.setattr(neardup.candidate_links, "__defaults__", (*neardup.candidate_links.__defaults__[:2], leaf))
    monkeypatch.setattr(neardup.confirmed_links, "__defaults__", (*neardup.confirmed_links.__defaults__[:3], chunk, 500 * chunk))
    texts = [None, "", "   ", "one two", "One\ttwo", "one two three", "a b c d e", "A b  c d e"]
    passage = prose(rnd, 60)
    for _ in range(14):
        base = prose(rnd, rnd.randrange(40, 260))
        texts += [base, *[edited(rnd, base, r) for r in (0.004, 0.01, 0.015, 0.02, 0.03)], base.upper()]
        texts.append(prose(rnd, 150) + " " + passage + " " + prose(rnd, 150))
    big = prose(rnd, 300)
    texts += [edited(rnd, big, 0.008) for _ in range(60)] + [big] * 10 + [prose(rnd, 6000)]
    rnd.shuffle(texts)
    docs = frame(spark, texts)
    want = near_brute(list(enumerate(texts)))
    rows = neardup.near_duplicates(clashing(docs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    more = docs.unionByName(docs.limit(3)).unionByName(frame(spark, ["x y z"], [None]))
    got = neardup.near_duplicates(more).collect()
    assert len(got) == len(texts) + 4 and [r.kept for r in got if r.doc_id is None] == [True]


def test_near_duplicates_of_repeated_ids(spark):
    rnd = random.Random(22)
    a, b, c = (prose(rnd, 200) for _ in range(3))
    texts = [a, b, edited(rnd, a, 0.005), edited(rnd, b, 0.005), c, "", c + " x", prose(rnd, 50)]
    ids = [1, 1, 2, 3, 7, 7, 9, 12]
    for cast in ("long", "string"):
        df = frame(spark, texts, ids).withColumn("doc_id", F.col("doc_id").cast(cast))
        got = sorted((int(r.doc_id), int(r.component_id), r.kept) for r in neardup.near_duplicates(df).collect())
        assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (7, 7, True), (7, 7, True), (9, 7, False), (12, 12, True)]


def test_recall_in_a_large_node(spark):
    import numpy as np

    rnd = np.random.default_rng(23)
    n, pairs = 6000, 600
    common = rnd.integers(-30000, 30000, neardup.COORDINATES, dtype=np.int16)
    sig = np.where(rnd.random((n, neardup.COORDINATES)) < 0.55, common, rnd.integers(-30000, 30000, (n, neardup.COORDINATES), dtype=np.int16))
    sig[pairs : 2 * pairs] = np.where(rnd.random((pairs, neardup.COORDINATES)) < 0.87, sig[:pairs], sig[pairs : 2 * pairs])
    sig[2 * pairs : 4 * pairs] = np.where(rnd.random((2 * pairs, neardup.COORDINATES)) < 0.97, sig[2 * pairs], sig[2 * pairs : 4 * pairs])  # a large group of copies
    reps = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sig)], "rep long, sig binary")
    from tickloom.llm.components import components

    comp = {r.id: r.component for r in components(neardup.candidate_links(reps)).collect()}
    caught = sum(comp.get(i, -1) == comp.get(pairs + i, -2) for i in range(pairs))
    assert caught >= 0.97 * pairs, caught
    assert len({comp.get(i) for i in range(2 * pairs, 4 * pairs)}) == 1


def test_near_duplicates_empty(spark):
    assert neardup.near_duplicates(frame(spark, [])).count() == 0
    assert {r.component_id for r in neardup.near_duplicates(frame(spark, [None, "", "only one here"])).collect()} == {0, 1, 2}


# --- repeated substrings ----------------------------------------------------------------------------------------------


def repeats_brute(rows):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for _, r in raw:
        for s in range(len(r) - 199):
            seen[r[s : s + 200]] = seen.get(r[s : s + 200], 0) + 1
    out = {}
    for i, r in raw:
        cut = [False] * len(r)
        for s in range(len(r) - 199):
            if seen[r[s : s + 200]] > 1:
                cut[s : s + 200] = [True] * 200
        runs = sum(c and not (k and cut[k - 1]) for k, c in enumerate(cut))
        out[i] = (len(r), sum(cut), runs, hashlib.sha256(bytes(b for b, c in zip(r, cut) if not c)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [substrdup.HOT, 2])
def test_repeated_substrings(spark, hot, monkeypatch):
    rnd = random.Random(8)
    monkeypatch.setattr(substrdup, "SEGMENT", 3000)
    noise = lambda n: "".join(rnd.choice("abcdefgh éß") for _ in range(n))
    passages = [noise(n) for n in (150, 199, 205, 260, 420, 900)]
    texts = [None, "", "short", "a" * 900, "ab" * 300, "a" * 199, noise(9000)]
    for k in range(40):
        p = rnd.choice(passages)
        cut = rnd.randrange(max(1, len(p) - 210))
        texts.append(noise(rnd.randrange(400)) + p[cut:] + noise(rnd.randrange(400)) + (p if k % 3 == 0 else ""))
    texts += [texts[10], texts[10] + "x", texts[6][2900:3400] + noise(100)]
    docs = frame(spark, texts)
    got = {r.doc_id: tuple(r)[1:] for r in substrdup.remove_repeats(clashing(docs), hot=hot).collect()}
    assert got == repeats_brute(list(enumerate(texts)))


def test_repeated_rows_and_nothing(spark):
    t = "".join(random.Random(1).choice("abcdef") for _ in range(500))
    rows = substrdup.remove_repeats(frame(spark, [t, t, "x"], [1, 1, None]), kept_bytes=True).collect()
    assert sorted((r.n_removed, bytes(r.kept)) for r in rows) == [(0, b"x"), (500, b""), (500, b"")]
    assert substrdup.remove_repeats(frame(spark, [])).count() == 0
