from collections import Counter

from helpers import awkward, awkward_rows, empty

from fettle.llm import lines


def brute(rows, ratio=0.1, least=3):
    """(doc_id, text, n_lines, n_dropped) of rows (doc_id, text, source)."""
    pages, totals = Counter(), Counter()
    for _, text, source in rows:
        totals[source] += 1
        pages.update({(source, x.strip(" ")) for x in (text or "").split("\n") if x.strip(" ")})
    out = []
    for doc_id, text, source in rows:
        if text is None:
            out.append((doc_id, None, 0, 0))
            continue
        kept = []
        for line in text.split("\n"):
            n = pages[source, line.strip(" ")]
            if not (n >= least and n > totals[source] * ratio):
                kept.append(line)
        n = text.count("\n") + 1
        out.append((doc_id, "\n".join(kept), n, n - len(kept)))
    return Counter(out)


def result(df):
    return Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect())


def test_awkward_rows(spark):
    out = lines.drop_boilerplate(awkward(spark))
    assert out.columns == [*awkward(spark).columns, "n_lines", "n_dropped"]
    assert result(out) == brute([(r[0], r[1], r[3]) for r in awkward_rows()])
    assert {(r["_block"], r["sequence_id"]) for r in out.collect()} == {("x", "y"), (None, None)}
    clash = awkward(spark).selectExpr("doc_id", "text", "source", "text as _host", "source as _text", "1 as n_lines", "`_block` as _row")
    again = lines.drop_boilerplate(clash)
    assert result(again) == result(out) and again.columns[-2:] == ["n_lines", "n_dropped"]


def test_hosts_are_apart(spark):
    rows = [(i, f"own {i}\n  menu \n\nmenu", "a") for i in range(20)]
    rows += [(100 + i, f"menu\nown {i}" if i < 2 else f"own {i}", "b") for i in range(20)]
    rows += [(200 + i, "shared" if i < 4 else f"x{i}", None) for i in range(40)]  # a tenth, not more
    out = result(lines.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert out == brute(rows)
    assert out[0, "own 0\n", 4, 2] == 1 and out[100, "menu\nown 0", 2, 0] == 1 and out[200, "shared", 1, 0] == 1


def test_copies_count_once(spark):
    """A text that is a third of its source stays; a line of many different texts goes."""
    rows = [(i, "first of a copy\nsecond of a copy", "a") for i in range(30)]
    rows += [(100 + i, f"menu\nown {i}" if i % 2 else f"own {i}", "a") for i in range(60)]
    rows += [(200 + i, "only text", "b") for i in range(3)] + [(300 + i, None, "b") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r["text"] for r in lines.drop_boilerplate(docs, copies_once=True).collect()}
    assert out == {i: t.replace("menu\n", "") if t else None for i, t, _ in rows}


def test_empty(spark):
    assert lines.drop_boilerplate(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = lines.drop_boilerplate(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
