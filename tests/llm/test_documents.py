import random
from collections import Counter

import numpy as np

from siftworks.llm import decontaminate as dc
from siftworks.llm import language_id as li
from siftworks.llm import quality_rules as qr
from siftworks.llm import toxicity as tx
from siftworks.llm.common import WORD, fold

EXTRA = "doc_id long, text string, lang string, score string, kept string"


def brute_statistics(text):
    words = WORD.findall(text or "")
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in qr.SYMBOLS), lines, len(marked)


def test_statistics():
    draw = random.Random(3)
    texts = [None, "", " ", "a\n\na\nb\na \n", "x " * 30, "É#é| <b>", " wide ", "😀 $ $"]
    texts += [" ".join(draw.choice("ab") for _ in range(draw.randrange(60))) for _ in range(40)]
    for text in texts:
        assert qr.statistics(text)[0] == brute_statistics(text)


def test_repeated_lines_are_judged_by_labels(spark):
    draw = random.Random(1)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    plain = lambda n: [" ".join(word() for _ in range(8)) for _ in range(n)]
    bad = lambda: "\n".join(line for one in plain(12) for line in (one, "abcde fghij"))
    rows = [(i, "\n".join(plain(15)) if i % 4 else bad(), None, None, None) for i in range(400)]
    docs = spark.createDataFrame(rows, EXTRA)
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(320)], "doc_id long, quality int")
    found = {r["doc_id"]: r for r in qr.quality_rules(docs, labels).collect()}
    assert not any(r["base_failed"] for r in found.values())
    assert {d: r["kept"] for d, r in found.items()} == {d: d % 4 > 0 for d in found}


def test_quality_rules(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = {r["doc_id"]: r for r in qr.quality_rules(docs, labels).collect()}
    for row in docs.collect():
        got = found[row["doc_id"]]
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == brute_statistics(row["text"])
        assert got["base_failed"] == (got["n_words"] < 20 or 100 * got["n_repeat_words"] > 30 * got["n_words"])
        assert not (got["base_failed"] and got["kept"])
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    judged = [found[d] for d in good if d in found and not found[d]["base_failed"]]
    assert sum(r["kept"] for r in judged) >= 0.99 * len(judged)
    bad = {r["doc_id"] for r in labels.where("quality = 0").collect()}
    assert sum(found[d]["kept"] for d in bad if d in found) <= 0.1 * len([d for d in bad if d in found])


def test_repeated_ids_count_once_by_their_smallest_text(spark):
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice(["alpha", "beta", "gamma", "delta", "of", "to"]) for _ in range(30 + i % 9)) + "".join(" " + "#" * k for k in range(1, 10) if i % 4 == 0)) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i, _ in rows], "doc_id long, quality int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    more = once.unionByName(once.selectExpr("doc_id", "concat('zz ', text) AS text")).unionByName(once.selectExpr("doc_id", "cast(NULL AS string) AS text")).repartition(5)
    a, b = qr.fit(once, labels), qr.fit(more, labels)
    assert a[1] == b[1] and np.array_equal(a[0].cut, b[0].cut, equal_nan=True)


def test_quality_learns_from_every_labelled_row(spark):
    from pyspark.sql import functions as F
    ids = spark.range(21_000).select(F.col("id").alias("doc_id"))
    last = ids.orderBy(F.xxhash64("doc_id").desc()).first()["doc_id"]
    bad = F.col("doc_id") == last
    odd = " ".join(f"${'#' * i} $" for i in range(20))
    plain = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(21)), lambda i: F.concat(F.lit("w"), i * F.col("doc_id"))), " ")
    docs = ids.select("doc_id", F.when(bad, F.lit(odd)).otherwise(plain).alias("text"))
    model = qr.fit(docs.repartition(4), ids.select("doc_id", F.when(bad, 0).otherwise(1).alias("quality")))
    score = lambda d: model[0].score(np.array([qr.statistics(docs.where(F.col("doc_id") == d).first()["text"])[1]]))[0]
    assert score(last) > model[1] >= score((last + 1) % 21_000)


def test_quality_threshold_against_a_plain_one(spark):
    draw = np.random.default_rng(4)
    for n, levels in ((300, 40), (2000, 10 ** 9), (3, 2)):
        scores = draw.integers(0, levels, n) / levels
        good = draw.random(n) < 0.8
        good[:2] = True, False
        scores[~good] += 0.3
        cuts = np.unique(scores)
        lost = 1 - np.array([(scores[good] <= c).sum() for c in cuts]) / good.sum()
        caught = 1 - np.array([(scores[~good] <= c).sum() for c in cuts]) / (~good).sum()
        gain = np.where(lost <= 0.1, caught - lost, -1)
        best = np.flatnonzero(gain == gain.max())
        middle = best[len(best) // 2]
        rows = spark.createDataFrame([(float(s), int(g)) for s, g in zip(scores, good)], "score double, good int").repartition(3)
        assert qr.threshold(rows, 0.1) == (cuts[middle] + cuts[min(middle + 1, len(cuts) - 1)]) / 2


def test_quality_without_labels_and_kept_rows(spark):
    docs = spark.createDataFrame([(1, "word " * 5, None, "s", "k"), (2, " ".join(f"w{i}" for i in range(30)), None, None, None), (3, None, None, None, None)], EXTRA)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["doc_id"]: r["kept"] for r in qr.quality_rules(docs, labels).collect()} == {1: False, 2: True, 3: False}
    kept = qr.quality_rules(docs, labels, rows=True)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [2]
    assert qr.quality_rules(docs.limit(0), labels).count() == 0


def distance(item, text):
    """Least edit distance of the item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_edit_matches_against_brute_force(spark):
    draw = random.Random(8)
    words = ["tion", "the", "ing", "re", "stand", "of", "able", "over"]
    item = lambda n: " ".join(draw.choice(words) for _ in range(n))
    items = [(i, item(draw.randrange(2, 25))) for i in range(16)] + [(50, None), (51, ""), (52, "too few words"), (53, "Same  words, as the one before"), (54, "same words as the one BEFORE")]
    docs = [(0, None), (1, "")]
    for i in range(60):
        text = item(40)
        source = draw.choice(items[:16] + items[-2:])[1]
        for _ in range(draw.randrange(0, 8)):
            at = draw.randrange(len(source))
            source = source[:at] + draw.choice(["", "x", "zz", source[at] + "q"]) + source[at + 1:]
        docs.append((2 + i, f"{text}. {source.upper()}; {item(10)}"))
    table = spark.createDataFrame([(d, t, None, None, None) for d, t in docs], EXTRA)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in dc.edit_matches(table, benchmark).collect()}
    want = {}
    for d, text in docs:
        for i, t in items:
            p = dc.plain(t)
            if p:
                found, allowed = distance(p, dc.plain(text)), dc.PERCENT * len(p) // 100
                if found <= allowed and (allowed or f" {p} " in f" {dc.plain(text)} "):
                    want[d, i] = found
    assert got == want and any(v > 0 for v in want.values())
    clean = dc.decontaminate(table, benchmark)
    assert clean.columns == table.columns and {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    spans = {(r["doc_id"], r["item_id"]): dict(docs)[r["doc_id"]][r["start"]:r["end"]] for r in dc.edit_matches(table, benchmark).collect()}
    assert all(dc.plain(spans[d, 53]) == "same words as the one before" for d, i in want if i == 53 and want[d, i] == 0)
    assert dc.edit_matches(table, benchmark.limit(0)).count() == 0 and dc.edit_matches(table.limit(0), benchmark).count() == 0


def test_short_unspaced_and_unnamed_items(spark):
    chinese = "长江是亚洲最长的河流之一也是世界第三长的河流全长六千三百公里"
    texts = {1: "The answer: FORTY-two!", 2: "forty twofold", 3: f"问{chinese}答", 4: f"问{chinese[:9]}X{chinese[10:]}答", 5: "in 东京 now", 6: "a :-) b", 7: "unnamed item here", 8: "none of it", 9: None}
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in texts.items()], EXTRA)
    items = [(1, "forty two"), (2, chinese), (3, "京"), (4, " :-) "), (None, "unnamed item"), (5, ""), (6, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["distance"], texts[r["doc_id"]][r["start"]:r["end"]]) for r in dc.edit_matches(docs, benchmark).collect()}
    assert got[4, 2][0] == 1 and {k: v for k, v in got.items() if k != (4, 2)} == {(1, 1): (0, "FORTY-two"), (3, 2): (0, chinese), (5, 3): (0, "京"), (6, 4): (0, ":-)")}
    assert {r["doc_id"] for r in dc.decontaminate(docs, benchmark).collect()} == {2, 8, 9}


def test_budget_is_by_characters_not_words(spark):
    """An item of four words and 49 characters may have 2 edits, as any item of its length."""
    item = "photosynthesis transforms electromagnetic energy!"
    docs = spark.createDataFrame([(1, "so photosynthesis transfoms electromagnetic enrgy it is", None, None, None), (2, "photosynthesis tranfoms electomagnetic energy", None, None, None)], EXTRA)
    got = dc.edit_matches(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["distance"], r["budget"]) for r in got] == [(1, 2, 2)]


def test_items_without_letters_are_found_together(spark):
    texts = {1: "x  ...\n --> y ;-)", 2: "--> ...", 3: "--\u00a0>", 4: None, 5: ""}
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in texts.items()], EXTRA)
    benchmark = spark.createDataFrame([(1, "... -->"), (2, " -->"), (3, "-- >"), (4, ";-)"), (5, ")")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): texts[r["doc_id"]][r["start"]:r["end"]] for r in dc.edit_matches(docs, benchmark).collect()}
    assert got == {(1, 1): "...\n -->", (1, 2): "-->", (1, 4): ";-)", (1, 5): ")", (2, 2): "-->", (3, 3): "--\u00a0>"}


def test_benchmark_in_several_batches(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    whole = {tuple(r) for r in dc.edit_matches(docs, benchmark).collect()}
    monkeypatch.setattr(dc, "BATCH_CHARS", 3000)
    assert whole == {tuple(r) for r in dc.edit_matches(docs, benchmark).collect()} and whole


def viterbi(scores, switch):
    best, back = [scores[0]], []
    for row in scores[1:]:
        last, step, pointers = best[-1], [], []
        for k in range(len(row)):
            origin = int(np.argmax(last))
            if last[origin] - switch > last[k]:
                step.append(last[origin] - switch + row[k])
                pointers.append(origin)
            else:
                step.append(last[k] + row[k])
                pointers.append(k)
        best.append(step)
        back.append(pointers)
    path = [int(np.argmax(best[-1]))]
    for pointers in reversed(back):
        path.append(pointers[path[-1]])
    return path[::-1]


def test_batched_viterbi_equals_plain_one():
    draw = np.random.default_rng(4)
    model = li.Model(["a", "b", "c"], {g: draw.normal(-5, 3, 3) for g in "qwertyuiop"}, np.full(3, -5.0), {"latin": np.array([True, True, True])})
    texts = [["".join(draw.choice(list("qwertyuiop"), draw.integers(1, 5))) for _ in range(n)] for n in (0, 1, 7, 40, 3, 40)]
    labels, letters = model.label(texts)
    for words, got, count in zip(texts, labels, letters):
        want = viterbi([model.rows[model.memo[w]].astype(float).tolist() for w in words], li.SWITCH) if words else []
        assert got.tolist() == want and count.sum() == sum(map(len, words))


def test_scores_of_many_words_are_those_of_one():
    draw = np.random.default_rng(6)
    table = {g: draw.normal(-5, 3, 2) for g in ("a", "b", "ab", "^a", "b$", "aba", "^ab", "abab", "ж", "^ж", "é")}
    model = li.Model(["x", "y"], table, np.array([-7.0, -8.0]), {"latin": np.array([True, True]), "cyrillic": np.array([True, False])})
    words = ["a", "ab", "abab", "b" * 300, "ж", "жab", "é", "你", "Ab", "İ", "ba"]
    model.places([words, words[:3]])
    assert all(np.allclose(model.rows[model.memo[w]], model.score(w.lower()), atol=1e-4) for w in words)


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    keep = ~(fold("doc_id", 5) == 0)
    truth = {r["doc_id"]: r["lang"] for r in docs.where(~keep).collect()}
    got = {r["doc_id"]: r for r in li.identify(docs, keep).collect()}
    assert len(got) == docs.count() and np.mean([got[d]["lang_pred"] == lang for d, lang in truth.items()]) > 0.98
    odd = spark.createDataFrame([(1, None, "en", "", ""), (2, "123 !!", "en", "", ""), (3, "", None, "", "")], EXTRA)
    mixed = odd.unionByName(docs.select("doc_id", "text", "lang").withColumn("score", fold("doc_id", 2).cast("string")).withColumn("kept", fold("doc_id", 2).cast("string")))
    found = {r["doc_id"]: r for r in li.identify(mixed.where("doc_id < 4 and score = ''").unionByName(mixed.where("score <> ''").limit(100)), mixed["text"].isNotNull()).collect() if r["doc_id"] < 4}
    assert found[2]["score"] == 0.0 or found[2]["lang_pred"] != "und"
    assert [r["lang_pred"] for r in li.identify(odd, keep).collect()] == ["und"] * 3
    assert li.identify(odd.limit(0), keep).count() == 0


def test_learning_against_plain_counts(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(i, " ".join("".join(draw.choices("abcde", k=draw.randrange(1, 6))) for _ in range(6)), draw.choice(["en", "fr", None])) for i in range(60)] + [(99, "zażółć gęślą", "pl"), (98, "слово", "ru"), (97, None, "pl")]
    docs = spark.createDataFrame([(*r, "", "") for r in rows], "doc_id long, text string, lang string, score string, kept string").repartition(4)
    for sample, most, least in ((1000, 10**6, 0), (8, 10**6, 0), (1000, 0, 5)):
        monkeypatch.setattr(li, "SAMPLE", sample)
        monkeypatch.setattr(li, "MOST_GRAMS", most)
        monkeypatch.setattr(li, "LEAST_GRAMS", least)
        order = {r["doc_id"]: (r["h"], r["doc_id"]) for r in docs.selectExpr("doc_id", "xxhash64(doc_id) AS h").collect()}
        counts = {}
        for lang in ("en", "fr", "pl", "ru"):
            mine = sorted((order[i], t) for i, t, own in rows if own == lang and t is not None)[:sample]
            counts[lang] = Counter(g for _, t in mine for w in li.LETTERS.findall(t) for g in li.grams(w))
        best = {g for c in counts.values() for g in sorted(c, key=lambda g: (-c[g], g.encode()))[:max(least, most // 4)]}
        model = li.learn(docs, docs["doc_id"] >= 0)
        assert model.languages == sorted(counts) and set(model.table) == best
        totals = {lang: sum(c[g] for g in best) + li.SMOOTHING * (len(best) + 1) for lang, c in counts.items()}
        assert all(np.allclose(line, [np.log((counts[lang][g] + li.SMOOTHING) / totals[lang]) for lang in model.languages]) for g, line in model.table.items())


def test_scripts_that_no_language_has_give_no_score(spark):
    docs = spark.createDataFrame([(1, "some plain words", "en", "", ""), (2, "des mots simples", "fr", "", ""), (3, "слово и дело", None, "", ""), (4, "plain слов", None, "", "")], "doc_id long, text string, lang string, a string, b string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in li.identify(docs, docs["lang"].isNotNull()).collect()}
    assert got[3] == ("en", 0.0) and got[4] == ("en", 5 / 9) and got[1] == ("en", 1.0)


def test_mixed_text_has_spans():
    table = {"x": np.array([-1.0, -6.0]), "y": np.array([-6.0, -1.0])}
    model = li.Model(["a", "b"], table, np.array([-4.0, -4.0]), {"latin": np.array([True, True])})
    labels, _ = model.label([["xx"] * 10 + ["yy"] * 10])
    text = " ".join(["xx"] * 10 + ["yy"] * 10)
    assert li._spans(text, labels[0], model.languages) == [(0, 29, "a"), (30, 59, "b")]


def test_toxicity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    keep = ~(fold("doc_id", 3) == 1)
    found = {r["doc_id"]: r for r in tx.toxicity(docs, labels, keep).collect()}
    held = labels.where(~keep & (labels["quality"] == 1)).collect()
    assert np.mean([found[r["doc_id"]]["predicted"] == r["toxic"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found.values())
    odd = spark.createDataFrame([(1, None, "", "", ""), (2, "", "", "", ""), (2, "fine words", "", "", "")], EXTRA)
    assert [r["predicted"] for r in tx.toxicity(odd, labels, keep).collect()] == [0, 0, 0]
    assert tx.toxicity(odd, labels.limit(0), keep).count() == 3 and tx.toxicity(odd.limit(0), labels, keep).count() == 0


def test_grammar_of_clauses():
    grammar = tx.Grammar({"=idiot": 4.0, "moro": 3.0})
    plain, negated = grammar.clauses("an idiot")[0], grammar.clauses("not an idiot")[0]
    reported, targeted = grammar.clauses("she said idiot")[0], grammar.clauses("you idiot")[0]
    assert plain == 4.0 and negated == 4.0 * tx.NEGATED and targeted == 4.0 * tx.TARGETED
    assert reported == 4.0 * tx.REPORTED * tx.TARGETED
    assert grammar.clauses("not. idiot! Moronic") == [4.0, 3.0]
    assert grammar.clauses("kill you") == [tx.THREAT_WEIGHT * tx.TARGETED] and grammar.clauses("kill time") == []
    assert grammar.clauses(None) == grammar.clauses("") == []
