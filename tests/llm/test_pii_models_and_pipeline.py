import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starmill.llm import decontaminate, language, toxicity
from starmill.llm.pii import permuted_digits, pseudonymize
from texts import awkward, empty, frame, prose

SMALL = "/root/testdata/sf0.001"


def luhn(digits):
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in twice) % 10 == 0


@pytest.mark.parametrize("width", [2, 3])
def test_digits_are_permuted(spark, width):
    digits = spark.range(10 ** width).select(F.lpad(F.col("id").cast("string"), width, "0").alias("d"))
    found = [r[0] for r in digits.select(permuted_digits(F.col("d"), "k", "test")).collect()]
    assert sorted(found) == [str(i).zfill(width) for i in range(10 ** width)]


def test_valid_numbers_change_in_format_and_stay_linked(spark):
    first = "Pay 4111 1111 1111 1111 by 2024-02-29, mail jo.doe@example.org, from 10.1.2.3."
    second = "Again jo.doe@example.org; card 4111 1111 1111 1111!"
    invalid = "No card 4111 1111 1111 1112, no date 2024-02-30, no address 300.1.2.3."
    a, b, c, again = (r["text"] for r in pseudonymize(frame(
        spark, [(1, first), (2, second), (3, invalid), (4, first)]), "k").orderBy("doc_id").collect())
    card, mail = re.search(r"\d{4} \d{4} \d{4} \d{4}", a)[0], re.search(r"\S+@example\.org", a)[0]
    assert luhn(card.replace(" ", "")) and card in b and mail in b and mail != "jo.doe@example.org"
    assert re.fullmatch(r"Pay [\d ]{19} by \d{4}-\d\d-\d\d, mail \S+@example\.org, from [\d.]{7,15}\.", a)
    assert "4111 1111" not in a and c == invalid and again == a
    assert pseudonymize(frame(spark, [(1, first)]), "other").first()["text"] != a


def test_awkward_rows_keep_columns_and_number(spark):
    docs = awkward(spark)
    for found in (pseudonymize(docs, "k").drop("n_replaced"), decontaminate.without_passages(docs, benchmark(spark))):
        assert Counter(map(tuple, found.collect())) == Counter(map(tuple, docs.collect()))
        assert found.columns == docs.columns
    assert pseudonymize(empty(spark), "k").collect() == []
    assert decontaminate.find_passages(empty(spark), benchmark(spark)).collect() == []


ITEMS = [(1, prose(900, 40)), (2, prose(901, 12)), (3, "what is the capital of it"), (4, None), (5, ""), (5, prose(900, 40))]


def benchmark(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("_item", F.lit(1))


def test_passages_equal_a_search_of_all_windows(spark):
    docs = [(d, f"{prose(d, 5 + d)} {prose(900, 40)} {prose(d + 500, 9)}") for d in range(20)]
    one_word = prose(900, 40).split()
    one_word[3] = "changed"
    docs += [(100, f"{prose(31, 23)} {' '.join(one_word)} {prose(32, 20)}"), (101, f"so {prose(901, 12)} there"),
             (102, "Say: What is the capital of it?"), (103, "what is not the capital of it")]
    docs += [(200 + d, prose(600 + d, 80)) for d in range(20)]
    best = {}
    for d, text in docs:
        words = decontaminate.words_of(text)
        for item, passage in ITEMS:
            wanted = decontaminate.words_of(passage or "")
            weights = decontaminate.shingle_weights(wanted)
            for at in range(len(words) - len(wanted) + 1) if wanted else ():
                here = words[at:at + len(wanted)]
                like = decontaminate.similarity(weights, decontaminate.shingle_weights(here)) \
                    if len(wanted) >= 7 else float(here == wanted)
                if like >= decontaminate.SIMILARITY and like > best.get((d, item), (0, 0))[0]:
                    best[d, item] = like, at
    found = decontaminate.find_passages(frame(spark, docs), benchmark(spark))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == set(best)
    kept = decontaminate.without_passages(frame(spark, docs), benchmark(spark))
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in best}


def test_language_backs_off_to_shorter_grams(spark):
    rows = [(i, " ".join(f"{'kra' if i % 2 else 'lumi'}{'kt' if i % 2 else 'ena'}{(i * 7 + k) % 9 * 'a'}" for k in range(12)),
             "xa" if i % 2 else "xb") for i in range(60)]
    model = language.learn(frame(spark, rows, "doc_id long, text string, lang string"))
    texts = [(1, "krakt"), (2, "lumiena"), (3, "krakakt"), (4, "lumilumi"), (5, None), (6, "12 !"), (7, "")]
    found = {r["doc_id"]: r for r in language.identify(frame(spark, texts), model).collect()}
    assert [found[d]["lang_pred"] for d in range(1, 8)] == ["xa", "xb", "xa", "xb", "und", "und", "und"]
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert language.identify(awkward(spark), model).count() == awkward(spark).count()
    assert language.identify(empty(spark), model).collect() == []
    untaught = language.learn(frame(spark, [], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in language.identify(frame(spark, texts), untaught).collect()} == {"und"}


def test_held_out_language(spark):
    found = language.op2_language_id(spark, "/root/testdata/sf0.01").where("held_out")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang IS NOT NULL").select("doc_id", "lang")
    right = found.join(truth, "doc_id").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_toxicity_learns_words_that_mark_it(spark):
    rows = [(i, prose(i, 30) + (" vile rotten scum you " if i % 3 == 0 else " kind and good you ") + prose(i + 999, 30))
            for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(160)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    docs = frame(spark, rows)
    network = toxicity.learn(docs, labels)
    found = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, network).collect()}
    toxic, clean = ([found[i] for i in range(160, 240) if (i % 3 == 0) == wanted] for wanted in (True, False))
    assert min(toxic) > max(clean)
    assert toxicity.score_toxicity(awkward(spark), network).count() == awkward(spark).count()
    assert toxicity.score_toxicity(empty(spark), network).collect() == []


def test_toxicity_of_held_out_rows_with_few_labels(spark):
    """About thirty toxic documents to learn from, eighteen held out."""
    found = toxicity.op6_toxicity(spark, "/root/testdata/sf0.01").where("held_out")
    truth = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("toxic IS NOT NULL")
    shares = {r["toxic"]: r["share"] for r in found.join(truth, "doc_id").groupBy("toxic").agg(
        F.avg("predicted").alias("share")).collect()}
    assert shares[1] >= 0.5 and shares[0] <= 0.02


def test_stages_work_on_what_the_one_before_kept(spark):
    found = corpus_pipeline.run(spark, SMALL).select("doc_id").distinct()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert found.join(docs, "doc_id", "left_anti").count() == 0 and 0 < found.count() <= docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert [f.name for f in kept.schema] == [f.name for f in docs.schema], name
        assert kept.dtypes == docs.dtypes, name
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "near dedup", "decontamination", "packing"]
