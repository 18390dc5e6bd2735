import re

from fixtures import documents, empty

from tidemart.llm import linerules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_base_figures_against_brute_force(spark):
    docs = documents(spark)
    texts = [r.text for r in docs.collect()]
    rows = linerules.judged(docs).collect()
    found = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert found == sorted(brute(t) for t in texts)
    for r in rows:
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


def test_lines_are_removed_by_rule(spark):
    good = "This is a plain sentence with enough words to count as a real line of text, nothing else in it."
    other = "Another sentence follows it here, long enough that what the three rules take away is a small part of all."
    text = "\n".join([good, "Home | News | Sports | Weather | Contact", "%%% *** $$$ &&& ###",
                      "We use cookies to improve this site", other])
    row = linerules.judged(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.clean_text == "\n".join([good, other])
    assert (row.n_lines, row.n_removed_lines, row.kept) == (5, 3, True)


def test_a_document_that_loses_too_much_goes(spark):
    words = " ".join(f"word{i}" for i in range(30))
    text = words + "\n" + "\n".join(f"menu{i} | item{i} | a{i} | b{i} | c{i}" for i in range(20))
    row = linerules.judged(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert not row.base_failed and not row.kept


def test_empty_table_and_native_plan(spark):
    assert linerules.judged(empty(spark)).count() == 0
    plan = linerules.judged(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
