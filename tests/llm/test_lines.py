from helpers import documents, odd_docs, odd_rows

from ledgerlark.llm import lines


def test_templates_with_fields_are_dropped_from_hosts_and_copies(spark):
    own = "This paragraph of document {0} says what no other one says about subject {0} at all, with its own words {1}."
    rows = [(i, own.format(f"n{chr(97 + i)}", " ".join(f"{chr(97 + i)}{chr(97 + k)}" for k in range(20))) + f"\nServed to user{i} at 10:{i:02d} by the proxy\nshort {i}", "x") for i in range(12)]
    copy = "\n".join(f"A line of the copied text that has number {w} in it" for w in ("one", "two", "six", "ten"))
    rows += [(100 + i, copy + f"\nedit{chr(97 + i)} made to this one copy", "x") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, tokens string")
    out = {r.doc_id: r for r in lines.drop_recurring_lines(docs).collect()}
    for i in range(12):
        assert out[i].n_dropped == 1 and out[i].text == rows[i][1].replace(f"\nServed to user{i} at 10:{i:02d} by the proxy", "")
        assert out[100 + i].n_dropped == 0 and out[100 + i].text == rows[12 + i][1]


def test_odd_rows(spark):
    docs = odd_docs(spark, [(20 + i, f"text number {i}\nall of this line recurs in many texts\n" + f"own{i} " * 40, "en", "a", 5) for i in range(10)])
    out = lines.with_lines_dropped(docs)
    assert out.columns == docs.columns and out.count() == len(odd_rows()) + 10
    rows = {r.doc_id: r for r in out.where("doc_id >= 20").collect()}
    assert all("recurs" not in r.text and r.n_chars == len(r.text) for r in rows.values())
    assert out.where("doc_id = 1").collect()[0].text is None
    assert out.where("doc_id = 4").collect()[0].text == docs.where("doc_id = 4").collect()[0].text
    assert lines.drop_recurring_lines(docs.limit(0)).count() == 0


def test_equal_texts_count_once(spark):
    rows = [(i, "the very same line of text\nand another one of it", None) for i in range(50)]
    out = lines.drop_recurring_lines(spark.createDataFrame(rows, "doc_id bigint, text string, x string")).collect()
    assert all(r.n_dropped == 0 for r in out)


def test_counts_of_lines(spark):
    docs = documents(spark, "doc_id < 50")
    assert all(r.n_lines == (r.text or "").count("\n") + 1 + r.n_dropped for r in lines.drop_recurring_lines(docs).collect() if r.n_lines > r.n_dropped)
