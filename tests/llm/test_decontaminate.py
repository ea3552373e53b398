from tests.llm.helpers import documents, odd_rows, words
from tickframe.llm import decontaminate as dc

ITEM = ("After lunch our friend Anna had 12 apples and gave Bob 5 apples. How many apples remain for "
        "Anna after 3 days? She paid 10 km.")
OTHER = ITEM.replace("Anna", "Carla").replace("Bob", "Dan").replace("12", "99").replace("10", "20")


def _items(spark, rows):
    return spark.createDataFrame([(i, t, "clash") for i, t in rows],
                                 "item_id long, text string, window string")


def test_templates(spark):
    raw = spark.createDataFrame([("It ran 3.5 km. Then Bob ran 2 km, and IBM saw 7%",)], "t string")
    df = raw.select(dc.raw_tokens(dc.F.col("t")).alias("raw")).select(
        dc.templates(dc.F.col("raw")).alias("t"))
    assert df.first().t == ["it", "ran", "<num>", "<unit>", "then", "<name>", "ran", "<num>",
                            "<unit>", "and", "ibm", "saw", "<num>", "<unit>"]


def test_leaks(spark):
    plain = " ".join(words(1, 40))
    rows = odd_rows() + [
        (20, "Before that. " + ITEM), (21, "Intro words here. " + OTHER + " More."),
        (22, OTHER.replace("for Carla", "for Erik")),  # slot contradicts
        (23, f"{' '.join(words(2, 200))} {plain.upper()} {' '.join(words(3, 10))}"),
        (24, " ".join(words(1, 12))),  # a short part only
        (25, " ".join(words(9, 300))), (20, "Before that. " + ITEM), (None, OTHER)]
    got = dc.leaks(documents(spark, rows), _items(spark, [
        (1, ITEM), (2, plain), (3, None), (4, ""), (5, "two words"), (None, "1 2 3 4 5 6 7")]))
    assert sorted(((r.doc_id, r.item_id) for r in got.collect()), key=str) == sorted(
        [(20, 1), (21, 1), (23, 2), (None, 1)], key=str)


def test_shuffled_join_equals_broadcast(spark, monkeypatch):
    docs = documents(spark, [(1, ITEM), (2, OTHER), (3, " ".join(words(4, 50)))])
    items = _items(spark, [(1, ITEM)])
    first = sorted(map(tuple, dc.leaks(docs, items).collect()))
    monkeypatch.setattr(dc, "MAX_BROADCAST", 0)
    assert sorted(map(tuple, dc.leaks(docs, items).collect())) == first and len(first) == 2


def test_removal_and_empty_tables(spark):
    docs = documents(spark, [(1, ITEM), (2, " ".join(words(5, 50))), (3, None)])
    kept = dc.without_leaks(docs, _items(spark, [(1, ITEM)]))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert dc.leaks(documents(spark, []), _items(spark, [(1, ITEM)])).count() == 0
    assert dc.leaks(docs, _items(spark, [])).count() == 0


def test_removal_tells_rows_of_one_id_apart(spark):
    rows = [(None, ITEM), (None, "a clean text of its own"), (None, None), (7, OTHER), (7, "clean")]
    kept = dc.without_leaks(documents(spark, rows), _items(spark, [(1, ITEM)])).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(
        [rows[1], rows[2], rows[4]], key=str)


def test_redrawn_numbers_may_coincide_and_sentences_may_start_with_names(spark):
    apples = ("The farmer sold 12 apples at the market and then ate 5 apples on the way home with "
              "the 5 children of the village")
    anna = "Anna has 12 apples. Anna gives Bob 5. How many are left?"
    rows = [(1, apples.replace("12", "7").replace("5", "7")), (2, anna.replace("Anna", "Mary")),
            (3, apples.replace("ate 5", "ate 8")), (4, anna), (5, " ".join(words(9, 60)))]
    got = dc.leaks(documents(spark, rows), _items(spark, [(1, apples), (2, anna)])).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (2, 2), (3, 1), (4, 2)]


def test_items_without_a_usable_window_match_verbatim(spark):
    items = [(1, "What is 12 + 15?"), (2, "Compute 12 * 34 + 56 - 78"), (3, "日本の首都はどこですか"),
             (4, ITEM), (5, "?!")]
    rows = [(1, "so: what is 12 + 15? 27"), (2, "First compute 12 * 34 + 56 - 78 now"),
            (3, "問題日本の首都はどこですか。東京"), (4, "what is 12 + 16"), (5, "日本の首都は"),
            (6, None), (7, "12 15")]
    got = dc.leaks(documents(spark, rows), _items(spark, items)).collect()
    assert sorted((r.doc_id, r.item_id, r.coverage) for r in got) == [
        (1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0)]


def test_short_items_match_whole_documents_only(spark):
    items = [(1, "Yes."), (2, "What is 12 + 15?"), (3, "東京"), (4, "True or false?")]
    rows = [(1, "I said yes to the plan."), (2, "yes"), (3, "  Yes!\n"), (4, "what is 12 + 15? 27"),
            (5, "東京は大きい"), (6, "東京"), (7, "it is true or false?"), (8, "true or false")]
    docs = documents(spark, rows)
    got = dc.leaks(docs, _items(spark, items)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(2, 1), (3, 1), (4, 2), (6, 3), (8, 4)]
    kept = dc.without_leaks(docs, _items(spark, items[:1])).collect()
    assert sorted(r.doc_id for r in kept) == [1, 4, 5, 6, 7, 8]
