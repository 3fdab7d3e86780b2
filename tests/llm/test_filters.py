import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from riskweave.llm.code_table import CodeTable
from riskweave.llm.kneser_ney import EXTRA, ORDER, SYMBOLS, Reader, calibration, discounts, ngram_codes, quality, train
from riskweave.llm.toxicity import (COST_DROP, COST_IMITATE, COST_KEEP, COST_REPEAT, IMITATIONS, CharModel, Restorer,
                                    count_characters, fit, toxicity)

CLEAN = "the river runs over stones while people walk along its bank and talk about weather food music work family".split()
BAD = "idiot moron stupid".split()


def _text(rng, n, bad=()):
    words = [rng.choice(CLEAN) for _ in range(n)]
    for b in bad:
        words.insert(rng.randrange(len(words)), b)
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(600):
        bad = [rng.choice(BAD) for _ in range(rng.randint(1, 3))] if i % 5 == 0 else []
        docs.append((i, _text(rng, rng.randint(20, 60), bad), "en"))
        labels.append((i, int(bool(bad)), 1))
    docs += [(1000, _text(rng, 30, ["1d10t"]), "en"), (1001, _text(rng, 30, ["m o r o n"]), "en"),
             (1002, _text(rng, 30, ["stuuupiiid"]), "en"), (1003, _text(rng, 30, ["s.t.u.p.i.d"]), "en"),
             (1004, _text(rng, 30, ["$tup1d"]), "en"), (1010, None, "en"), (1011, "", None), (None, _text(rng, 30), "en"),
             (1012, _text(rng, 3000), "en"), (1013, _text(rng, 30), "xx"), (1013, _text(rng, 30), "xx")]
    labels += [(5, 1, None), (6, None, None), (None, 1, 1), (0, 0, 0)]
    return docs, labels


def _frames(spark, corpus):
    docs = spark.createDataFrame(corpus[0], "doc_id long, text string, lang string").selectExpr(
        "*", "1 as score", "'y' as kept", "0 as predicted")
    return docs, spark.createDataFrame(corpus[1], "doc_id long, toxic int, quality int").selectExpr("*", "'z' as text")


def test_lattice_restores(spark, corpus):
    model = count_characters(_frames(spark, corpus)[0])
    restorer = Restorer(model)
    for token, word in (("1d10t", "idiot"), ("stuuupiiid", "stupid"), ("s.t.u.p.i.d", "stupid"), ("$tup1d", "stupid"),
                        ("w3ather", "weather"), ("m0ron", "moron"), ("weather", "weather")):
        assert word in restorer.token(token), (token, restorer.token(token))
    assert restorer.token("2024") == () and restorer.token("") == () and restorer.token("weather!!!!") == ("weather",)


def test_character_counts_by_hand(spark):
    docs = spark.createDataFrame([("ab ab",), ("ba",), (None,), ("",)], "text string")
    model = count_characters(docs)
    by_hand = np.zeros(64 ** 3)
    for word, n in (("ab", 2), ("ba", 1)):
        codes = [0, 0, *(ord(c) - 96 for c in word), 0]
        for k in range(2, len(codes)):
            by_hand[(codes[k - 2] * 64 + codes[k - 1]) * 64 + codes[k]] += n
    assert np.allclose(model.cost, CharModel(by_hand).cost)


def test_toxicity(spark, corpus):
    docs, labels = _frames(spark, corpus)
    got = {}
    for r in toxicity(docs, labels).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(corpus[0])
    toxic = {i for i, t, _ in corpus[1] if t == 1}
    right = sum(got[i][0]["predicted"] == (i in toxic) for i in range(600))
    assert right >= 0.98 * 600
    for i in (1000, 1001, 1002, 1003, 1004):
        assert got[i][0]["predicted"] == 1, i
    for i in (1010, 1011, 1012, 1013, None):
        assert got[i][0]["predicted"] == 0, i
    assert len(got[1013]) == 2
    for i, rows in got.items():
        assert all(0 <= r["score"] <= 1 for r in rows)
        assert rows[0]["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)


def test_toxicity_without_labels_or_rows(spark, corpus):
    docs, labels = _frames(spark, corpus)
    assert {r["score"] for r in toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity(docs.limit(0), labels).collect() == []


def test_held_out_labels_are_not_learnt(spark, corpus):
    docs, labels = _frames(spark, corpus)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic")
    a, b = fit(docs, labels), fit(docs, flipped)
    assert a.share == b.share and np.allclose(a.weights, b.weights)


def test_code_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2 ** 60, 5000))
    table = CodeTable(keys, np.arange(len(keys), dtype=np.float32))
    asked = np.concatenate([keys, rng.integers(0, 2 ** 60, 500)])
    want = {int(k): i for i, k in enumerate(keys)}
    got = table.find(asked)
    assert all((math.isnan(g) and int(k) not in want) or g == want.get(int(k)) for k, g in zip(asked, got))


def _brute_kn(texts):
    """Interpolated modified Kneser-Ney over symbols, straight from the definition."""
    def symbol(c):
        if c.isascii():
            return ord("0") + 1 if c.isdigit() else ord(c) + 1
        return 129 + EXTRA.index(c)
    grams = {k: Counter() for k in range(1, ORDER + 1)}
    for t in texts:
        line = [0] * (ORDER - 1) + [symbol(c) for c in t]
        for i in range(ORDER - 1, len(line)):
            grams[ORDER][tuple(line[i - ORDER + 1:i + 1])] += 1
    for k in range(ORDER - 1, 0, -1):
        for g in grams[k + 1]:
            grams[k][g[1:]] += 1
    cut = {}
    for k in grams:
        n = Counter(min(c, 5) for c in grams[k].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        each = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0,
                3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        cut[k] = [min(max(d, 0.01), j - 0.01 * (j > 1)) if d > 0 else 0.5 for j, d in enumerate(each, 1)]
    total, given = {k: Counter() for k in grams}, {k: Counter() for k in grams}
    for k in grams:
        for g, c in grams[k].items():
            total[k][g[:-1]] += c
            given[k][g[:-1]] += cut[k][min(c, 3) - 1]

    def p(h, w):
        k = len(h) + 1
        lower = 1 / SYMBOLS if k == 1 else p(h[1:], w)
        if not total[k][h]:
            return lower
        c = grams[k][h + (w,)]
        return (c - cut[k][min(c, 3) - 1] if c else 0) / total[k][h] + given[k][h] / total[k][h] * lower
    return p, symbol


@pytest.mark.parametrize("shard_rows", [2_000_000, 500])
def test_probabilities_by_the_definition(spark, shard_rows):
    rng = random.Random(2)
    texts = [_text(rng, 30) + " é 12." for _ in range(40)]
    model = train(spark.createDataFrame([(t,) for t in texts], "text string"), shard_rows=shard_rows)
    assert (model.shards > 1) == (shard_rows == 500)
    p, symbol = _brute_kn(texts)
    asked = ["the river ZZ", "weather é 9", texts[0]]
    codes, _ = ngram_codes(asked)
    got = Reader(model).log_probabilities(codes)
    want = []
    for t in asked:
        line = [0] * (ORDER - 1) + [symbol(c) for c in t]
        want += [math.log(p(tuple(line[i - ORDER + 1:i]), line[i])) for i in range(ORDER - 1, len(line))]
    assert np.allclose(got, want, atol=1e-4)
    total = sum(p(tuple([0] * (ORDER - 1)), w) for w in range(SYMBOLS))
    assert abs(total - 1) < 1e-9


def test_quality(spark, corpus):
    docs, labels = corpus
    rng = random.Random(9)
    junk = [(2000 + k, " ".join("%$#@"[rng.randrange(4)] * 3 + str(rng.random()) for _ in range(30)), "en") for k in range(20)]
    frame, marks = _frames(spark, (docs + junk, labels))
    got = {}
    for r in quality(frame, marks).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(docs) + len(junk)
    assert sum(got[i][0]["keep"] for i in range(600)) >= 0.97 * 600
    assert not any(got[2000 + k][0]["keep"] for k in range(20))
    assert got[1010][0]["perplexity"] is None and not got[1010][0]["keep"] and not got[1011][0]["keep"]
    assert got[1012][0]["keep"] and len(got[1013]) == 2


def test_quality_without_trusted_text_or_rows(spark, corpus):
    frame, marks = _frames(spark, corpus)
    kept = {r["doc_id"]: r["keep"] for r in quality(frame, marks.limit(0)).collect()}
    assert kept[3] and not kept[1010]
    assert quality(frame.limit(0), marks).collect() == []


def test_discounts_stay_in_range(spark):
    for counts in ([], [1], [1, 1, 2], [5, 6], [1, 2, 2, 2, 3, 4]):
        d = discounts(spark.createDataFrame([(i, c) for i, c in enumerate(counts)], "code long, n long"))
        assert all(0 < x < k + 1e-9 for k, x in enumerate(d, 1))


def test_disguises_of_every_form(spark, corpus):
    docs, labels = _frames(spark, corpus)
    restorer = Restorer(count_characters(docs))
    for token, word in (("st" + "u" * 60 + "pid", "stupid"), ("stuupid", "stupid"), ("idiiot", "idiot"), ("іdіоt", "idiot"),
                        ("weather_" * 5 + "1d10t_m0ron", "moron"), ("s.t.u.p.i.d.m.o.r.o.n." * 3, "moron")):
        assert word in restorer.token(token), (token, restorer.token(token))
    spelled = "the river runs over 1d10t stones while people walk along its bank".replace(" ", "")
    offsets = np.array([0, len(spelled)])
    (_, words), = restorer.spaced(list(spelled), np.arange(len(spelled)), offsets)
    assert len(spelled) > 40 and "idiot" in words
    rng = random.Random(3)
    forms = ["stu pid", "id iot", "st up id", "stuupid", "іdіоt", "st" + "u" * 60 + "pid"]
    more = [(3000 + k, _text(rng, 15) + " " + x + " " + _text(rng, 15), "en", 1, "y", 0) for k, x in enumerate(forms)]
    found = {r["doc_id"]: r["predicted"] for r in toxicity(docs.union(spark.createDataFrame(more, docs.schema)), labels).collect()}
    assert [found[3000 + k] for k in range(len(forms))] == [1] * len(forms)
    assert found[1012] == 0


def test_evidence_is_bounded_by_its_ratio(spark, corpus):
    docs, labels = _frames(spark, corpus)
    model = fit(docs, labels, max_cues=3)
    assert {"=" + w for w in BAD} <= set(model.share) and "=river" not in model.share


def _readings(token):
    """Every (channel cost, letters) of a token, spelled out."""
    first = next((i for i, c in enumerate(token) if c.isalnum()), len(token))
    last = max((i for i, c in enumerate(token) if c.isalnum()), default=-1)
    found = [(0.0, "")]
    for i, c in enumerate(token):
        more = []
        for cost, text in found:
            if c.isalpha() and c not in IMITATIONS:
                more.append((cost, text + c))
                if i and token[i - 1] == c and text.endswith(c):
                    more.append((cost + COST_REPEAT, text))
            else:
                more += [(cost + COST_IMITATE, text + x) for x in IMITATIONS.get(c, "")]
                more.append((cost + (COST_DROP if not c.isalnum() or not first <= i <= last else COST_KEEP), text))
        found = more
    return found


def test_lattice_is_searched_whole(spark, corpus):
    model = count_characters(_frames(spark, corpus)[0])

    def cost(text):
        line = [0, 0, *(model.code[c] for c in text), 0]
        return sum(float(model.cost[x]) for x in zip(line, line[1:], line[2:]))
    rng = random.Random(12)
    tokens = ["*?*?*", "8*6*?1", "stt0nne", "ffllooww"]
    tokens += ["".join(rng.choice("aeirstt1?*0@.-") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    tokens += ["".join(c * rng.choice((1, 1, 2)) for c in rng.choice(CLEAN + BAD)) for _ in range(100)]
    for token in tokens:
        best = {}
        for spent, text in _readings(token):
            best[text] = min(best.get(text, math.inf), spent + cost(text))
        assert best[model.decode(token)] == pytest.approx(min(best.values()), abs=1e-5), token


def test_all_cues_that_pass_are_kept(spark):
    words = ["bad" + a + b + c for a in "aeiou" for b in "klmnr" for c in "xyz"]
    rows = [(20 * i + j, f"{w} clean{20 * i + j} text", 1) for i, w in enumerate(words) for j in range(20)]
    rows += [(100_000 + k, f"plain words number{k} here", 0) for k in range(4500)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = fit(docs, labels)
    assert {"=" + w for w in words} <= set(model.share) and "=words" not in model.share


def test_scripts_are_told_apart():
    texts = ["\u3053\u3093\u306b\u3061\u306f", "\uc548\ub155\ud558\uc138\uc694", "\u043f\u0440\u0438\u0432\u0435", "\u03b1\u03b2\u03b3\u03b4\u03b5"]
    codes, offsets = ngram_codes(texts)
    assert len({tuple(codes[a:z]) for a, z in zip(offsets, offsets[1:])}) == len(texts)
    assert len(set(codes.tolist())) == sum(map(len, texts)) and codes.min() >= 0 and codes.max() < 1 << 55


def test_limits_by_a_plain_version(spark):
    """Levels and limits by language, recomputed from the perplexities; small languages have limits of their own."""
    rng = random.Random(21)
    sizes = {"en": 900, "de": 60, None: 40, "fr": 15}
    rows = [(lang, _text(rng, rng.randint(5, 60)) + ("!" if lang == "en" else " ," * 5)) for lang, n in sizes.items() for _ in range(n)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)] + [(9000, "words of no known language", "zz")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(len(rows))], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality(docs, labels).collect()}
    held = {r["doc_id"] for r in labels.filter(calibration()).collect()}
    log = {i: math.log(r["perplexity"]) for i, r in got.items()}
    def quantiles(values):
        values = sorted(values)
        return [values[max(0, math.ceil(p * len(values)) - 1)] for p in (0.005, 0.995)]

    def side(ids, k):
        """Level by language, limit by language, limit of other languages; k: 0 lower, 1 upper."""
        mean_all = sum(log[i] for i in ids) / len(ids)
        by_lang = {lang: [i for i in ids if got[i]["lang"] == lang] for lang in sizes}
        mean = {lang: sum(log[i] for i in at) / len(at) if at else mean_all for lang, at in by_lang.items()}
        rest = {i: (log[i] - mean[got[i]["lang"]]) * len(rows[i][1]) / (len(rows[i][1]) + 100) for i in ids}
        sd, z = float(np.std(list(rest.values()))), 2.5758293035489004 * (2 * k - 1)
        pooled = (len(ids) * quantiles(rest.values())[k] + 100 * z * sd) / (len(ids) + 100)
        wide = (2 * k - 1) * sd / 2
        limit = {}
        for lang, at in by_lang.items():
            own = quantiles(rest[i] for i in at)[k] if at else 0.0
            limit[lang] = mean[lang] + (len(at) * own + 100 * pooled) / (len(at) + 100) + wide
        return mean, limit, mean_all + pooled + wide
    (mean0, low, low_all), (mean1, high, high_all) = side(sorted(set(range(len(rows))) - held), 0), side(sorted(held), 1)
    for i in range(len(rows)):
        lang, n = got[i]["lang"], len(rows[i][1])
        assert math.log(got[i]["low_limit"]) == pytest.approx(low[lang], abs=1e-9)
        assert math.log(got[i]["high_limit"]) == pytest.approx(high[lang], abs=1e-9)
        drawn = [m[lang] + (log[i] - m[lang]) * n / (n + 100) for m in (mean0, mean1)]
        assert got[i]["keep"] == (low[lang] <= drawn[0] and drawn[1] <= high[lang])
    for lang, n in sizes.items():
        assert sum(got[i]["keep"] for i in range(len(rows)) if got[i]["lang"] == lang) >= 0.9 * n
    assert math.log(got[9000]["low_limit"]) == pytest.approx(low_all, abs=1e-9)
    assert math.log(got[9000]["high_limit"]) == pytest.approx(high_all, abs=1e-9)
