"""Fixed values, typed out: the registered SQL takes them from the library, so they are held here."""

from fettle.functions import labels, nulls, shapes, tokens
from fettle.functions.fuzzy import decision
from fettle.operators import evidence as ev
from fettle.operators import profile as pr
from fettle.operators.policies import DEFAULT_POLICY, POLICIES
from pyspark.sql import functions as F


def test_null_tokens():
    """Those that the usual CSV readers of data frames take for null."""
    assert set(nulls.NA_TOKENS) == {
        "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
        "NULL", "NaN", "None", "n/a", "nan", "null"}


def test_white_space_is_that_of_text():
    assert set(nulls.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_stop_words_and_terms():
    words = """about after also and are can could data dataset does from have how into most report reports should that
    the their there these this values what when which with would"""
    assert list(tokens.STOP_WORDS) == words.split()
    assert tokens.NOT_LOOKUPS == ("ABOUT", "DATA", "DATASET", "REPORT", "REPORTS")


def test_recommendations(spark):
    rows = [(0.0, "Rien à faire"), (0.001, "Imputation simple"), (4.999, "Imputation simple"),
            (5.0, "Imputation + colonne is_missing"), (40.0, "Imputation + colonne is_missing"),
            (40.001, "Évaluer l'utilité de la colonne"), (70.0, "Évaluer l'utilité de la colonne"),
            (70.001, "Suppression possible, sauf valeur métier importante"),
            (100.0, "Suppression possible, sauf valeur métier importante")]
    df = spark.createDataFrame(rows, "p double, want string")
    assert df.where(labels.recommend(F.col("p")) != F.col("want")).count() == 0


def test_reasons():
    assert labels.FULL_NAME == "nom complet reconnu"
    assert labels.ACRONYM == "forme évidente ou acronymie équivalente"
    assert labels.SAME_COMPACT == "même forme compacte après normalisation"
    assert labels.VALIDATED_PREFIX + "X" == "variante validée vers X"
    assert labels.STRONG_BUT_CHECK == "forte similarité mais validation recommandée"
    assert labels.AMBIGUOUS == "possible faute de frappe ou variante ambiguë"
    assert labels.OTHER_CONTEXT + "UQAM" == "contexte potentiellement distinct autour de UQAM"
    assert labels.CLOSE_BUT_CHECK == "proposition proche mais à vérifier"
    assert labels.CONFIRM_BY_HAND == "similarité à confirmer manuellement"
    assert labels.TOO_DIFFERENT == "similarité insuffisante ou contexte différent"


def test_decisions(spark):
    df = spark.createDataFrame([(100,), (95,), (94,), (80,), (79,), (0,)], "s int")
    got = [r[0] for r in df.select(decision(F.col("s"))).collect()]
    assert got == ["accepted", "accepted", "review", "review", "rejected", "rejected"]


def test_sizes():
    assert (ev.SECTION_CHARS, ev.HEADING_CHARS, ev.HEADING_BONUS, ev.BUDGET_CHARS, ev.QUESTION_TOKENS) == (2800, 250, 2, 26000, 10)
    assert ev.SEPARATOR == "\n\n" and ev.HEADING_PATTERN == r"^#{1,3}\s"
    assert (pr.DATE_NAME_RATE, pr.SHAPE_RATE, pr.DATE_MIN_LENGTH, pr.NUMBER_MAX_LENGTH) == (0.5, 0.9, 8, 20)
    assert (pr.DATE_HINTS, pr.TEXT_HINTS) == (("date", "start", "end"), ("name", "title", "description"))
    assert pr.SUMMARY_COLUMNS == ("decision", "status", "duplicate_type", "recommandation")
    assert shapes.NUMBER_NOISE == ",$ "


def test_figures_of_a_summary_text(spark):
    text = """- Original rows: 224,000
- Columns: 39
- Unique raw organization names: 77,631
- Unique cleaned organization names: 70,046
- Corrections applied in the cleaned file: 10,162
- Corrections left for review: 2,927
- Total duplicate rows flagged across rules: 81,814"""
    row = ev.extract_metrics(spark.createDataFrame([(text,), ("none",)], "t string"), "t").collect()
    assert row[0].asDict() == {
        "raw_rows": 224000, "columns": 39, "unique_raw_orgs": 77631, "unique_clean_orgs": 70046,
        "corrections_applied": 10162, "corrections_review": 2927, "duplicate_rows_flagged": 81814}
    assert set(row[1]) == {0}


def test_policies():
    by_column = {c: p for p in POLICIES for c in p.columns}
    fills = {
        "recipient_operating_name": "NOT_PROVIDED", "recipient_postal_code": "NOT_PROVIDED", "agreement_number": "NOT_PROVIDED",
        "recipient_type": "UNKNOWN", "agreement_type": "UNKNOWN", "recipient_country": "UNKNOWN", "recipient_city": "UNKNOWN",
        "foreign_currency_type": "NOT_APPLICABLE", "foreign_currency_value": "NOT_APPLICABLE",
        "agreement_end_date": "NOT_PROVIDED", "amendment_date": "NOT_APPLICABLE", "recipient_province": "NOT_APPLICABLE"}
    assert {c: by_column[c].fill for c in fills} == fills
    assert by_column["recipient_province"].otherwise == "UNKNOWN" and by_column["recipient_province"].expected == "CA"
    assert {c for c, p in by_column.items() if p.keep_raw} == {"recipient_type", "agreement_type"}
    assert DEFAULT_POLICY.fill == "UNKNOWN" and len(POLICIES) == 12
