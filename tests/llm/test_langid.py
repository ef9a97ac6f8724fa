import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from palimpsest.llm import langid as L
from palimpsest.llm.common import held_out

from .helpers import documents, empty_documents, odd_documents


def plain_model(rows, max_n):
    counts = {}
    for text, lang in rows:
        for w in L.words_of(text):
            c = counts.setdefault(lang, {})
            c.setdefault(0, Counter())[w] += 1
            p = f" {w} "
            for n in range(1, max_n + 1):
                for i in range(len(p) - n + 1):
                    c.setdefault(n, Counter())[p[i:i + n]] += 1
    return counts


def plain_predict(text, counts, max_n):
    langs, words = sorted(counts), L.words_of(text or "")
    if not words or not langs:
        return "und"
    total = {(k, n): sum(c.values()) for k in langs for n, c in counts[k].items()}

    def score(key, lang, n):
        x = counts[lang].get(n, {}).get(key)
        return L.PENALTY if not x else min(L.PENALTY, -math.log10(x / total[lang, n]))

    sums = dict.fromkeys(langs, 0.0)
    for w in words:
        keys, level = [w], 0
        if not any(w in counts[k].get(0, {}) for k in langs):
            p = f" {w} "
            for level in range(min(max_n, len(p)), 0, -1):
                keys = [g for g in (p[i:i + level] for i in range(len(p) - level + 1)) if any(g in counts[k].get(level, {}) for k in langs)]
                if keys:
                    break
        for k in langs:
            sums[k] += sum(score(g, k, level) for g in keys) / len(keys) if keys else L.PENALTY
    return min(langs, key=lambda k: (round(sums[k], 3), k))


def test_backoff_equals_the_plain_rule(spark):
    train = [("the cat sat on the mat", "en"), ("le chat est sur la table", "fr"), ("die katze sitzt auf der matte", "de"), ("the end", "en")]
    model = L.train(spark.createDataFrame(train, "text string, lang string"), max_n=4)
    counts = plain_model(train, 4)
    texts = ["the cat", "chatte tables", "katzen matten", "zzz qqq", "mat THE Chat", "", None, "123 !?", "sitzend", "x" * 5000]
    got = L.predict(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), model, "doc_id").collect()
    for r in got:
        assert r["lang_pred"] == plain_predict(texts[r["doc_id"]], counts, 4), texts[r["doc_id"]]
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["lang_pred"] != "und")


def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    held = held_out(F.col("doc_id"), 5, 0)
    model = L.train(docs.where(~held))
    got = L.predict(docs.withColumn("held", held), model, "lang", "held").where("held").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got >= 0.98


def test_label_source_and_id_are_no_inputs(spark):
    docs = documents(spark).limit(60)
    model = L.train(docs)
    a = {r["doc_id"]: r["lang_pred"] for r in L.predict(docs, model, "doc_id").collect()}
    b = {r["doc_id"]: r["lang_pred"] for r in L.predict(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")), model, "doc_id").collect()}
    assert a == b


def same_as_plain(spark, train, texts, max_n, **bound):
    model = L.train(spark.createDataFrame(train, "text string, lang string"), max_n=max_n, **bound)
    counts = plain_model(train, max_n)
    got = L.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, "doc_id").collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["lang_pred"] == plain_predict(texts[r["doc_id"]], counts, max_n), texts[r["doc_id"]]
    return model, {r["doc_id"]: r["score"] for r in got}


@pytest.mark.parametrize("frequent", [0, 3, 60, 10**6])
def test_the_bound_of_what_is_sent_moves_no_result(spark, frequent):
    docs = documents(spark).where("text is not null").select("text", "lang").limit(40).collect()
    train = [(r["text"][:400], r["lang"]) for r in docs[:25]] + [("same same counts counts", "aa"), ("same counts", "bb")]
    texts = [r["text"][400:900] for r in docs] + ["same", "counts same", "qqq zzz", "", None, "same counts"]
    model, scores = same_as_plain(spark, train, texts, 4, frequent=frequent)
    assert model.frequent().count() <= frequent
    _, all_sent = same_as_plain(spark, train, texts, 4)
    assert scores == pytest.approx(all_sent, abs=1e-9)


def test_all_counts_equal(spark):
    rows = [("one two three", "en"), ("un deux trois", "fr"), ("eins zwei drei", "de")]
    model, _ = same_as_plain(spark, rows, ["two", "deux trois", "zwei", "drei une"], 3, frequent=4)
    assert model.least is None and model.frequent().count() == 0  # nine words of one frequency: all are joined


def test_more_words_and_languages_than_any_list(spark):
    rows = [(f"word{'abcdefghij'[i % 10]}{chr(0x4e00 + i)}x shared", f"l{i:04d}") for i in range(1200)]
    rows += [(" ".join(f"{chr(0x4e00 + i)}{chr(0x4e00 + j)}" for j in range(200)), "many") for i in range(200)]
    texts = [rows[i][0] for i in (0, 7, 600, 1199)] + [f"{chr(0x4e00 + 150)}{chr(0x4e00 + 199)}", "shared", "unseen"]
    model = L.train(spark.createDataFrame(rows, "text string, lang string"), max_n=2, frequent=500)
    assert model.languages == 1201
    got = L.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, "doc_id").collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] < 6} == {0: "l0000", 1: "l0007", 2: "l0600", 3: "l1199", 4: "many", 5: "l0000"}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    model = L.train(docs)
    got = L.predict(docs, model, *docs.columns, out=("guess", "share"))
    assert got.count() == docs.count() and got.columns == [*docs.columns, "guess", "share"]
    assert {r["guess"] for r in got.where("text is null or text in ('', ' ', '\n')").collect()} == {"und"}
    nothing = L.train(empty_documents(spark))
    assert {r["guess"] for r in L.predict(docs, nothing, out=("guess", "share")).collect()} == {"und"}
    assert L.predict(empty_documents(spark), model, "doc_id").count() == 0


@pytest.mark.parametrize("text,words", [("Don't 12 stop", ["don", "t", "stop"]), ("", []), ("ÀÉ日本", ["àé日本"])])
def test_words(text, words):
    assert L.words_of(text) == words


def test_words_in_order_are_the_words_of_each_text():
    rng = random.Random(3)
    signs = [*"ab Z.,!?'_|\n\t\r\x01\x1c\x85\xa0éÉ́İΣσς日😀1²½Ⅷ٣ªßǅK\u3000", "  ", "ΑΣ", "x" * 65, "é" * 130, "²" * 70]
    texts = ["", " ", "²", "½ .", "a²", *["".join(rng.choices(signs, k=rng.randrange(12))) for _ in range(3000)]]
    for some in (texts, *[[t] for t in texts[:40]]):
        counts, places, words = L.words_in_order(some)
        ends = counts.cumsum()
        assert [[words[i] for i in places[b - n:b]] for n, b in zip(counts, ends)] == [L.words_of(t) for t in some]
        assert len(set(words)) == len(words)


def test_each_different_piece_of_a_step_is_cut_once(monkeypatch):
    cut = []

    class Words:
        findall = staticmethod(lambda text, plain=L._WORDS: cut.append(text) or plain.findall(text))

    monkeypatch.setattr(L, "_WORDS", Words)
    counts, places, words = L.words_in_order(["it's one-two three. " * 500] * 4)
    assert counts.tolist() == [2500] * 4 and len(words) == 5
    assert sorted(cut) == ["", "it's", "one-two"]  # before: each text whole
