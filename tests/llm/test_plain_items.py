"""Benchmark items with few literal words, names that open sentences and scripts without spaces."""

from lexiweave.llm import decontaminate


def found(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    table = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, table).collect())


def test_items_short_of_literals_are_found_verbatim(spark):
    items = ["What is 12 times 7?", "Compute 12 + 35 - 4 * 9.", "Name Paris, Rome, Berlin and Madrid.", "小明有12个苹果,他给了小红5个。", "ราคาเท่าไหร่"]
    texts = [f"Here it goes on. {x} And so on it went." for x in items] + ["What is 13 times 7?", "Name Paris, Rome, Lisbon and Madrid.", "小明 did not know", None, ""]
    texts.append("问题：小明有31个苹果,他给了小红7个。完")
    assert found(spark, texts, items) == [*((k, k) for k in range(5)), (10, 3)]


def test_names_that_open_sentences(spark):
    item = "Maria has 12 apples. Maria gives 5 to Paul. Maria buys 7 more. Maria eats 2. How many are left?"
    other = "Karen has 31 apples. Karen gives 8 to Fred. Karen buys 9 more. Karen eats 3. How many are left?"
    mixed = "Karen has 31 apples. Jonas gives 8 to Fred. Sofia buys 9 more. Peter eats 3. How many are left?"
    assert found(spark, [item, other, mixed, f"Well then. {other} Sure."], [item]) == [(0, 0), (1, 0), (3, 0)]
