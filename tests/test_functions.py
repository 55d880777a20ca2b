import random
import unicodedata

import brute
import pytest
from pyspark.sql import functions as F

from fettle.functions.alias import accept_alias, review_candidate
from fettle.functions.fuzzy import decision, repeat_similarity, similarity
from fettle.functions.labels import count_label, recommend
from fettle.functions.nulls import NA_TOKENS, WHITESPACE, canonical_null, is_blank, strip
from fettle.functions.shapes import date_shape, float_text, numeric_shape, stable_text
from fettle.functions.text import collapse_segments, compact_text, normalize_text
from fettle.functions.tokens import lookup_term, token_set, words_found


def apply(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    rows = df.select("i", fn(F.col("v")).alias("out")).collect()
    return [r["out"] for r in sorted(rows)]


def test_normal_form_examples(spark):
    cases = {
        " Université du Québec ": "UNIVERSITE DU QUEBEC",
        "Straße": "STRASSE",
        "Œuvre": "UVRE",
        "Ørsted": "RSTED",
        "½ x": "1 2 X",
        "№5": "N 5",
        "ª": "",
        "a b\tc": "A B C",
        "U.Q.A.M.": "U Q A M",
        "ﬁn ŉ": "FIN N",
        None: "",
    }
    assert apply(spark, cases, normalize_text) == list(cases.values())
    assert apply(spark, cases, compact_text) == [v.replace(" ", "") for v in cases.values()]


def test_normal_form_on_every_code_point(spark):
    """Blocks that hold letters, marks, forms and symbols with a compatibility form."""
    blocks = [(1, 0x3000), (0xA000, 0xAC00), (0xF900, 0xFFFE), (0x1D400, 0x1D800), (0x1F100, 0x1F200)]
    texts = ["x" + chr(c) + "y" for lo, hi in blocks for c in range(lo, hi)]
    got = apply(spark, texts, normalize_text)
    wrong = [(t, g) for t, g in zip(texts, got) if g != brute.normal(t)]
    assert wrong == []


def test_normal_form_on_random_text(spark):
    rng = random.Random(1)
    letters = "aZ9 -|/.éÉßŒø½№́ ﬁ漢"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 12))) for _ in range(400)]
    assert apply(spark, texts, normalize_text) == [brute.normal(t) for t in texts]
    assert apply(spark, texts, collapse_segments) == [brute.collapsed(t) for t in texts]


def test_collapse_examples(spark):
    cases = {"X / X": "X", "X/": "X/", "a|A|á": "a", " /X": "/X", "a/b": "a/b", " q ": "q", None: ""}
    assert apply(spark, cases, collapse_segments) == list(cases.values())


def test_white_space_is_the_unicode_set(spark):
    expected = [c for c in map(chr, range(0x3001)) if c.isspace()]
    assert sorted(WHITESPACE) == expected
    points = [chr(c) for c in range(1, 0x3100)]
    assert apply(spark, points, is_blank) == [c.isspace() for c in points]
    texts = [f"{c}x{c}y{c}" for c in points]
    assert apply(spark, texts, strip) == [t.strip() for t in texts]


def test_null_tokens_and_blanks(spark):
    values = [*NA_TOKENS, "  ", " \x1f", "NAN", " NA", "none", "x", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    both = [r.v for r in canonical_null(df).orderBy("i").collect()]
    n = len(NA_TOKENS)
    assert both == [None] * (n + 2) + ["NAN", " NA", "none", "x", None]
    read = [r.v for r in canonical_null(df, blanks=False).orderBy("i").collect()]
    assert read[n : n + 2] == ["  ", " \x1f"]
    kept = [r.v for r in canonical_null(df, na_tokens=()).orderBy("i").collect()]
    assert kept[1:n] == list(NA_TOKENS[1:])


def test_aliases(spark):
    names = ["U.Q.A.M.", "UQAM|uqam", "Université du Québec à Montréal", "AQAM", "coop-UQAM",
             "ESG UQAM", "UQAM Foundation Inc", "Laval", "", None]
    assert apply(spark, names, accept_alias) == [True] * 3 + [False] * 7
    assert apply(spark, names, review_candidate) == [False] * 3 + [True] * 3 + [False] * 4


@pytest.mark.parametrize(
    "name,expected",
    [("AQAM", 80), ("QAM", 93), ("COOP UQAM", 83), ("UQAMX", 94), ("UQAM ETS", 86), ("QAMAR", 76),
     ("Université du Québec à Montréal", 38), ("--", 0)],
)
def test_similarity_examples(spark, name, expected):
    assert apply(spark, [name], lambda c: similarity(c, F.lit("UQAM"))) == [expected]


def test_similarity_against_brute_force(spark):
    rng = random.Random(2)
    pairs = [
        ("".join(rng.choices("ABCD", k=rng.randint(0, 9))), "".join(rng.choices("ABCD", k=rng.randint(0, 9))))
        for _ in range(300)
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r.s for r in df.select("i", similarity(F.col("a"), F.col("b")).alias("s")).orderBy("i").collect()]
    assert got == [brute.score(a, b) for a, b in pairs]


def test_repeats_equal_full_similarity(spark):
    cases = [(k, j) for k in range(1, 5) for j in range(1, 5)]
    df = spark.createDataFrame(cases, "k int, j int")
    got = [r[0] for r in df.select(repeat_similarity(F.col("k"), F.col("j"))).collect()]
    assert got == [brute.score("ABC" * k, "ABC" * j) for k, j in cases]


def test_decision_limits(spark):
    assert apply(spark, [100, 95, 94, 80, 79, 0], decision, "int") == [
        "accepted", "accepted", "review", "review", "rejected", "rejected"]


def test_recommendation_limits(spark):
    # Missing cells, published percentage and treatment, out of 224,000 rows.
    known = [
        (223998, 100.0, "Suppression possible, sauf valeur métier importante"),
        (164764, 73.56, "Suppression possible, sauf valeur métier importante"),
        (150085, 67.0, "Évaluer l'utilité de la colonne"),
        (113951, 50.87, "Évaluer l'utilité de la colonne"),
        (85754, 38.28, "Imputation + colonne is_missing"),
        (45911, 20.5, "Imputation + colonne is_missing"),
        (47, 0.02, "Imputation simple"),
        (1, 0.0, "Imputation simple"),
        (0, 0.0, "Rien à faire"),
    ]
    df = spark.createDataFrame([(n,) for n, _, _ in known], "n long")
    percent = F.col("n") / 224000 * 100
    rows = df.select(F.round(percent, 2).alias("p"), recommend(percent).alias("r")).collect()
    assert [(r.p, r.r) for r in rows] == [(p, t) for _, p, t in known]
    edges = apply(spark, [5.0, 40.0, 40.01, 70.0, 70.01], recommend, "double")
    assert edges == [known[4][2], known[4][2], known[2][2], known[2][2], known[0][2]]


def test_count_label(spark):
    label = count_label(F.lit(223998), F.lit(99.9991).cast("double"))
    assert spark.range(1).select(label).first()[0] == "223,998 (100.00%)"


def test_shapes(spark):
    dates = ["2020-01-02", "2020-01-02 10:11:12", "2020/01/02", "1/2/2020", " 31/12/2020 ", "2020-1-2", "20200102", "x2020-01-02"]
    assert apply(spark, dates, date_shape) == [True] * 5 + [False] * 3
    numbers = ["1,234.50", "$ 12", "-.5", "5.", "1e3", "inf", "1d", "1_0", "", "x", "1 000"]
    assert apply(spark, numbers, numeric_shape) == [True] * 6 + [False] * 4 + [True]


def test_float_text_is_shortest_form(spark):
    values = [0.0, 1.0, -2.5, 112946.26, 12345678.9, 1.5e7, 9007199254740993.0, 1e15, 1e16, 2.5e20,
              1e-4, 0.00012, 1e-5, 1.5e-7, 1e100, float("inf"), float("-inf")]
    assert apply(spark, values, float_text, "double") == [repr(v) for v in values]


def test_stable_text(spark):
    df = spark.sql("""SELECT timestamp_ntz'2020-01-02 00:00:00' AS a, timestamp_ntz'2020-01-02 03:04:05' AS b,
        timestamp_ntz'2020-01-02 03:04:05.000600' AS c, date'2020-01-02' AS d, 7L AS e, CAST(NULL AS int) AS f, true AS g""")
    row = df.select(*[stable_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]).first()
    assert list(row) == ["2020-01-02", "2020-01-02 03:04:05", "2020-01-02 03:04:05.000600", "2020-01-02", "7", "", "True"]


def test_tokens(spark):
    text = "The Report of blue_gear, BLUE_gear; ab éclair x1y"
    assert apply(spark, [text, "", "a b", None], token_set) == [["blue_gear", "clair", "x1y"], [], [], None]
    found = apply(spark, [text, "blue", "BLUE-gear GEAR"], lambda c: words_found(c, ["blue", "gear", "x1y"]))
    assert found == [1, 1, 2]


def test_lookup_terms(spark):
    questions = ['see "Acme Inc" R-1-2', "see R-1-2/3 or ABCD", "ABOUT NASA and ESGUQAM, AQAMXYZ", "plain", "it's ab' DATA",
                 "É-x-y UQAM.CA"]
    assert apply(spark, questions, lookup_term) == ["Acme Inc", "R-1-2/3", "ESGUQAM", "", "s ab", "UQAM.CA"]


def test_code_points_fold_to_ascii_only(spark):
    from fettle.functions.text import fold_tables

    source, target, expanded = fold_tables()
    assert all(c.isascii() for c in target) and all(v.isascii() for v in expanded.values())
    removed = unicodedata.normalize("NFKD", source[len(target):])
    assert all(unicodedata.combining(c) for c in removed)
