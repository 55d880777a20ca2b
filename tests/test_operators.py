import random

import pytest
from collections import defaultdict

import brute
from pyspark.sql import functions as F

from fettle.operators import duplicates as dup
from fettle.operators import evidence as ev
from fettle.operators import mapping as mp
from fettle.operators import profile as pr
from fettle.operators import remediation as rm
from fettle.operators import search as se
from fettle.operators import summary as sm
from fettle.operators import variants as va
from fettle.operators.policies import DEFAULT_POLICY, POLICIES

NAMES = [
    "UQAM", "U.Q.A.M.", "UQAM|UQAM", "u q-am", "Université du Québec à Montréal",
    "UniversiteDu Quebec a Montreal", "UniversiteDu Quebec a Montreal|UniversiteDu Quebec a Montreal",
    "COOP UQAM", "AQAM", "QAM", "ESG-UQAM", "Blue Gear", "blue gear", "BLUE-GEAR", "Blue Gear / BLUE GEAR",
    "blue gear|Blue-Gear|BLUE GEAR", "bluegear|blue gear", "Blue Gear/", "Solo", "--", "/ |", "Æ", "Café", "Cafe", "CAFÉ ",
    "UQAM Foundation Incorporated",
]


def names_frame(spark, n=600, seed=3):
    rng = random.Random(seed)
    # One name holds a third of all rows.
    names = [rng.choice(NAMES) if rng.random() > 0.34 else "Blue Gear" for _ in range(n)]
    rows = [(i + 1, v) for i, v in enumerate(names)]
    return names, spark.createDataFrame(rows, "row_number long, name string").repartition(5)


def test_variants_against_brute_force(spark):
    names, df = names_frame(spark)
    rows = va.variants_report(df, "name").orderBy(*va.report_order()).collect()
    got = {r.original_value: (r.suggested_group, r.similarity_score, r.decision) for r in rows}
    assert got == brute.variants(names)
    assert len(rows) == len(got)
    assert {r.original_value: r["count"] for r in rows} == {n: names.count(n) for n in got}
    order = ["accepted", "review", "rejected"]
    keys = [(order.index(r.decision), -r["count"], r.original_value) for r in rows]
    assert keys == sorted(keys)


def test_canonical_ties(spark):
    rows = [(1, "A  B"), (2, "a b"), (3, "AB"), (4, "a-b"), (5, "X Y"), (6, "x-y")]
    df = spark.createDataFrame(rows, "row_number long, name string")
    got = {r.original_value: r.suggested_group for r in va.variants_report(df, "name").collect()}
    # Equal counts: the shortest normal form wins, then the first row.
    assert got == {"A  B": "AB", "a b": "AB", "AB": "AB", "a-b": "AB", "X Y": "X Y", "x-y": "X Y"}


def test_cleaning_invariants(spark):
    names, df = names_frame(spark)
    df = df.withColumn("name", F.when(F.col("row_number") % 10 != 0, F.col("name")))
    variants = va.variants_report(df, "name")
    mapping = mp.build_mapping(variants)
    clean = mp.apply_mapping(df, mapping, "name")
    assert clean.columns == ["row_number", "name", "name_clean"]
    assert clean.count() == df.count()
    accepted = {r.original_value: r.clean_value for r in mp.accepted_only(mapping).collect()}
    for r in clean.collect():
        assert r.name_clean == accepted.get(r.name, r.name)
    changed = mp.changed_count(clean, "name", "name_clean").first()[0]
    facts = {r.metric: r.value for r in mp.cleaning_summary(df, mapping, "name").collect()}
    assert facts["corrections_applied"] == changed > 0
    assert facts["rows_processed"] == len(names)
    assert facts["accepted_available"] + facts["mappings_skipped"] == mapping.count()
    # Keeping the first row of a value changes nothing when values are unique.
    again = mp.build_mapping(variants.unionByName(variants), unique=False)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mapping.collect()))


def test_reasons(spark):
    _, df = names_frame(spark)
    got = {r.original_value: (r.status, r.reason) for r in mp.build_mapping(va.variants_report(df, "name")).collect()}
    assert got["Université du Québec à Montréal"] == ("accepted", "nom complet reconnu")
    assert got["U.Q.A.M."] == ("accepted", "forme évidente ou acronymie équivalente")
    assert got["UQAM|UQAM"] == ("accepted", "même forme compacte après normalisation")
    assert got["QAM"] == ("review", "forte similarité mais validation recommandée")
    assert got["COOP UQAM"] == ("review", "possible faute de frappe ou variante ambiguë")
    assert got["Blue Gear / BLUE GEAR"] == ("review", "proposition proche mais à vérifier")
    assert got["blue gear|Blue-Gear|BLUE GEAR"] == ("rejected", "similarité insuffisante ou contexte différent")


COLUMNS = ["row_number", *dup.SAMPLE_COLUMNS]


def grant_rows(n=400, seed=4):
    rng = random.Random(seed)
    pick = lambda *v: rng.choice(v)
    rows = []
    for i in range(n):
        org = "Hot Org" if rng.random() < 0.34 else pick("A", " A", "B|city=x", "NA", "  ", None, "C")
        rows.append((i + 1, pick("R1 ", "R1", "R2", f"R{i}", None, ""), org, pick("x", "y ", None, "n/a"),
                     pick("K1", "K2", None), pick("2020-01-01", "2020-02-01", " "), pick("100", "100.0", "200")))
    return rows


def brute_duplicates(rows):
    from fettle.functions.nulls import NA_TOKENS

    clean = [(r[0], *["" if v is None or v in NA_TOKENS or not v.strip() else v for v in r[1:]]) for r in rows]
    groups = defaultdict(list)
    for r in clean:
        ref, org, city, postal, start, value = (v.strip() for v in r[1:])
        groups["exact_row", r[1:]].append(r)
        if ref:
            groups["ref_number", f"ref_number={ref}"].append(r)
        if org and start and value:
            groups["org_date_value", f"org={org}|date={start}|value={value}"].append(r)
        if org and city and postal:
            groups["org_city_postal", f"org={org}|city={city}|postal={postal}"].append(r)
    return {(t, len(g), *min(g)) for (t, _), g in groups.items() if len(g) > 1}


def test_duplicates_against_brute_force(spark):
    rows = grant_rows()
    schema = "row_number long, " + ", ".join(f"{c} string" for c in dup.SAMPLE_COLUMNS)
    df = spark.createDataFrame(rows, schema).repartition(6)
    report = dup.duplicate_report(df, exclude=["row_number"])
    got = report.collect()
    assert {(r[0], r[2], *r[3:]) for r in got} == brute_duplicates(rows)
    keys = [(r.duplicate_type, -r.duplicate_count, r.sample_row_number) for r in got]
    assert keys == sorted(keys)
    surplus = sum(r.duplicate_count - 1 for r in got)
    assert dup.total_flagged(report).first()[0] == surplus
    assert sum(r.duplicate_rows_flagged for r in dup.duplicate_summary(report).collect()) == surplus
    # With the row number as part of the row no two rows agree; an absent column disables its rule.
    assert "exact_row" not in {r[0] for r in dup.duplicate_report(df).collect()}
    found = {r[0] for r in dup.duplicate_report(df.drop("recipient_city")).collect()}
    assert found == {"ref_number", "org_date_value"}


def test_duplicate_keys_are_short_until_they_are_shown(spark):
    """Tasks hold all their keys: they had the name of the rule and a digest as 64 letters."""
    import hashlib

    df = spark.createDataFrame([(1, "é|", 7), (2, "é|", 7), (3, " ", 8)], "row_number long, a string, b int")
    rule = dup.KeyRule("pair", (("a", "a"), ("b", "b")))
    found = dup.duplicate_groups(df, [rule, dup.EXACT_ROW], exclude=["row_number"])
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "Aggregate [_rule" in plan and "unhex" in plan and "as binary" in plan
    whole = hashlib.sha256("3:é|1:7".encode()).hexdigest()
    assert {tuple(r) for r in found.collect()} == {("pair", "a=é||b=7", 2, 1), ("exact_row", whole, 2, 1)}
    assert found.schema["duplicate_key"].dataType.simpleString() == "string"


def test_summary_of_published_counts(spark):
    rows = [("org_city_postal", "94895"), ("org_date_value", "4553"), ("org_date_value", "x"), ("ref_number", None)]
    report = spark.createDataFrame(rows, "duplicate_type string, duplicate_count string")
    got = [tuple(r) for r in dup.duplicate_summary(report).collect()]
    assert got == [("org_city_postal", 1, 94894), ("org_date_value", 2, 4552), ("ref_number", 1, 0)]
    widest = [tuple(r) for r in dup.duplicate_summary(report, with_max=True).collect()]
    assert widest[0] == ("org_city_postal", 1, 94895, 94894)
    assert dup.total_flagged(report.limit(0)).first()[0] == 0


def test_missing_on_edge_tables(spark):
    empty = spark.createDataFrame([], "a string, b int")
    assert [tuple(r) for r in pr.missing_report(empty).collect()] == [
        ("a", 0, 0, 0.0, "Rien à faire"), ("b", 0, 0, 0.0, "Rien à faire")]
    full = spark.createDataFrame([("x", 1.0)], "a string, b double")
    assert pr.missing_profile(full).collect() == []
    odd = spark.createDataFrame([("x", float("nan")), ("", None)], "`a.b` string, b double")
    assert [tuple(r)[:3] for r in pr.missing_report(odd).collect()] == [("b", 2, 2), ("a.b", 1, 2)]


def test_roles_and_types(spark):
    rows = [(i, str(i), str(i) if i % 2 else None, f"2020-01-{i + 10}", "true", f"{i}.5", "x" if i else "  ", None,
             f"{i},000 $", f"2020010{i % 9}") for i in range(20)]
    schema = "id long, n string, gap string, start_on string, flag string, amount string, t string, nothing string, price string, end_code string"
    df = spark.createDataFrame(rows, schema)
    types = {r.column: r.detected_dtype for r in pr.column_dtypes(df, "id").collect()}
    assert types == {"id": "int64", "n": "int64", "gap": "float64", "start_on": "object", "flag": "bool",
                     "amount": "float64", "t": "object", "nothing": "float64", "price": "object", "end_code": "int64"}
    roles = {r.column: r.role for r in pr.column_roles(df, "id").collect()}
    assert roles == {"id": "numeric", "n": "numeric", "gap": "numeric", "start_on": "date", "flag": "text",
                     "amount": "numeric", "t": "text", "nothing": "text", "price": "numeric", "end_code": "numeric"}


def test_plan_covers_default_policy(spark):
    df = spark.createDataFrame([(None, None, "x")], "coverage string, other string, fine string")
    plan = {r["column"]: r["recommended decision"] for r in pr.remediation_plan(df, POLICIES, DEFAULT_POLICY).collect()}
    assert plan == {"coverage": "DELETE COLUMN", "other": "SET FIXED VALUE"}
    assert rm.unlisted_incomplete(df) == ["other"]


def test_value_profile_marks_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    assert [(r.value, r["count"]) for r in pr.value_profile(df, ["v"]).orderBy("rank").collect()] == [("a", 2), ("<missing>", 1)]


def test_search_rules(spark):
    df = spark.createDataFrame([(1, "Straße", None), (2, "nan", "b"), (3, "c", "STRASSE x")], "row_number long, a string, b string")
    found = se.search_report(df, "STRASSE", order=["row_number"])
    assert [r.row_number for r in found.collect()] == [1, 3]
    assert se.search_report(df, "  ", 2, order=["row_number"]).count() == 2
    # A null cell is not the text nan.
    assert [r.row_number for r in se.search_report(df, "nan", None).collect()] == [2]
    assert se.search_table(df, " ", ["a"]).count() == 0
    assert se.search_table(df, "strasse", ["b", "zz"]).columns == ["b"]
    assert se.filter_value(df, "a", "All").count() == 3
    top = spark.createDataFrame([("9",), ("10",), ("x",), (None,)], "v string")
    assert [r.v for r in se.top_rows(top, "v", 2).collect()] == ["10", "9"]
    assert [r.v for r in se.top_rows(top, "v", 2, ascending=True).collect()] == ["9", "10"]
    assert [r.a for r in se.clip_cells(df.select("a"), 3).collect()] == ["Str", "nan", "c"]
    pct = spark.createDataFrame([("20",), ("100.0",), ("19.99",), ("x",)], "p string")
    assert se.filter_range(pct, "p").count() == 2


def test_sections_against_brute_force(spark):
    texts = ["# A\nbody\n## B\nmore\n#### no\n", "intro\n### C\tx\n\n   \n## \n", "", "  \n", "plain " * 40,
             "#no heading\n# yes\r\n", "# a\n# b\n# c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = ev.split_sections(df, ["i"], "t", "i", n=50).orderBy("i", "section", "part").collect()
    got = defaultdict(list)
    for r in rows:
        got[r.i].append((r.section, r.part, r.chunk))
        assert r.label == f"{r.i} section {r.section}"
    assert dict(got) == {i: s for i, t in enumerate(texts) if (s := brute.sections(t, 50))}


def test_budget_against_brute_force(spark):
    rng = random.Random(5)
    for budget in (1, 2, 7, 50, 1000):
        texts = ["é" * rng.randint(0, 9) for _ in range(60)]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(4)
        assert ev.budget_concat(df, ["i"], budget=budget).first().text == brute.bounded(texts, budget)


def test_evidence_bundle_and_lookup(spark):
    table = spark.createDataFrame(
        [(1, "UQAM", "10.5"), (2, "x", "7"), (3, "uqam x", "bad"), (4, None, "1")],
        "row_number long, recipient_legal_name string, agreement_value string")
    totals = ev.lookup_totals(table, "Uqam")
    assert tuple(totals.first()) == (2, 10.5)
    assert tuple(ev.lookup_totals(table, "").first()) == (0, 0.0)
    assert [r.agreement_value for r in ev.lookup_rows(table, "uqam", n=1).collect()] == ["10.5"]
    assert ev.lookup_rows(table, "").count() == 0
    items = spark.createDataFrame([(1, 0, "a"), (0, 5, "b")], "part int, place long, text string")
    bundle = ev.evidence_bundle(items, ["one", "two"], totals).first()
    assert tuple(bundle) == ("b\n\na", ["one", "two"], 2)


def test_evidence_from_reports(spark):
    report = spark.createDataFrame([("x", "accepted"), ("blue y", "review"), ("blue z", "review")], "name string, status string")
    empty = report.limit(0)
    figures = spark.createDataFrame([(3, 2)], "rows long, columns long")
    sections = spark.createDataFrame([(1, 1, "doc section 1", "text")], "doc int, rank int, label string, chunk string")
    items = ev.gather_evidence(
        "blue?", figures, figures.select("rows"), [("full", report, ["name"]), ("none", empty, ["name"])], sections, "doc")
    assert [r.text for r in items.orderBy("part", "place").collect()] == [
        "[project metrics]\nrows: 3\ncolumns: 2",
        "[dataset lookup]\nrows: 3",
        "[full] Rows: 3; columns: name, status\nstatus counts: review=2, accepted=1",
        "[full relevant rows]\nname,status\nblue y,review\nblue z,review",
        "[none] Report is missing or empty.",
        "[doc section 1]\ntext",
    ]


def test_metrics_from_text(spark):
    text = "- Original rows: 224,000\n- Columns: 39\n- Corrections left for review: 2,927\n"
    df = spark.createDataFrame([(text,), ("none",)], "t string")
    rows = [r.asDict() for r in ev.extract_metrics(df, "t").collect()]
    assert rows[0]["raw_rows"] == 224000 and rows[0]["columns"] == 39
    assert rows[0]["corrections_review"] == 2927 and rows[0]["unique_raw_orgs"] == 0
    assert set(rows[1].values()) == {0}


def test_summary_without_cleaned_table(spark):
    _, df = names_frame(spark)
    mapping = mp.build_mapping(va.variants_report(df, "name"))
    report = spark.createDataFrame([("a", 3)], "duplicate_type string, duplicate_count long")
    facts = {r.metric: r.value for r in sm.final_summary(df, report, mapping, "name", cleaned=False).collect()}
    assert facts["distinct_clean"] == 0 and facts["corrections_applied"] == 0
    assert facts["distinct_raw"] == df.select("name").distinct().count()
    assert facts["duplicate_rows_flagged"] == 2 and facts["columns"] == 2


def test_remediation(spark):
    schema = """row_number long, amendment_number string, amendment_date string, recipient_country string,
      recipient_province string, foreign_currency_value string, recipient_type string, coverage string, other string"""
    rows = [
        (1, "0", None, "CA", None, None, " ", None, "a"),
        (2, "1", None, "US", None, "5", "A", "x", None),
        (3, "1", "2020-01-01", "US", None, "5", "A", None, "b"),
        (4, "0", "2020-01-01", None, None, None, "A", None, "c"),
    ]
    df = spark.createDataFrame(rows, schema)
    treated = rm.remediate(df, unlisted=["other"])
    curated = {r.row_number: r for r in rm.curated_rows(treated).collect()}
    assert set(curated) == {1, 3, 4} and "coverage" not in treated.columns
    assert curated[1].amendment_date_status == "NOT_APPLICABLE" and curated[3].amendment_date_status is None
    assert [curated[i].recipient_province for i in (1, 3, 4)] == ["UNKNOWN", "NOT_APPLICABLE", "UNKNOWN"]
    assert curated[1].foreign_currency_value is None
    assert curated[1].foreign_currency_value_status == "NOT_APPLICABLE"
    assert (curated[1].recipient_type, curated[1].recipient_type_raw) == ("UNKNOWN", None)
    assert curated[4].recipient_country == "UNKNOWN" and curated[4].recipient_country_was_missing
    assert [r.row_number for r in rm.review_rows(df).collect()] == [2]
    checks = {r.check: r.failures for r in rm.remediation_checks(df, treated, unlisted=["other"]).collect()}
    assert set(checks.values()) == {0} and "row_conservation" in checks
    broken = treated.where("row_number <> 3").withColumn("recipient_type", F.lit(None).cast("string"))
    failed = {r.check: r.failures for r in rm.remediation_checks(df, broken, unlisted=["other"]).collect()}
    assert failed["row_conservation"] == 1 and failed["populated:recipient_type"] == 2
    audit = {(r.column, r.action): r.cells for r in rm.remediation_audit(df, unlisted=["other"]).collect()}
    log = defaultdict(int)
    for r in rm.remediation_log(df, unlisted=["other"]).collect():
        log[r.column, r.action] += 1
    assert {k: n for k, n in audit.items() if k[1] != "DROPPED COLUMN"} == dict(log)
    # The only row with a coverage and without "other" is the one held for review, untouched.
    assert audit["amendment_date", "SENT TO REVIEW"] == 1 and audit["coverage", "DROPPED COLUMN"] == 0
    assert ("other", "FILLED UNKNOWN") not in audit and audit["recipient_province", "FILLED NOT_APPLICABLE"] == 1


def test_profile_after_treatment(spark, sf_dir):
    """A row for each column; a column that was not filled, and one that lost cells, fail."""
    from fettle.plans.grants import grants

    view = grants(spark, sf_dir)
    treated = rm.remediate(view)
    profile = {r.column: r for r in rm.remediation_profile(view, treated).collect()}
    assert list(profile) == view.columns and all(r.after == r.expected for r in profile.values())
    assert profile["recipient_country"].before > 0 and profile["recipient_country"].after == 0
    assert profile["agreement_end_date"].after == profile["agreement_end_date"].before > 0
    broken = treated.withColumns(
        {
            "recipient_country": F.when(~F.col("recipient_country_was_missing"), F.col("recipient_country")),
            "recipient_postal_code": F.when(F.col("recipient_postal_code_was_missing"), "n/a").otherwise(F.col("recipient_postal_code")),
            "agreement_end_date": F.coalesce("agreement_end_date", F.lit("2020-01-01")),
        }
    )
    checks = {r.check: r.failures for r in rm.remediation_checks(view, broken).collect()}
    failed = {k.split(":")[1] for k, n in checks.items() if n and k.startswith("profile:")}
    assert failed == {"recipient_country", "recipient_postal_code", "agreement_end_date"}
    assert {f"profile:{c}" for c in view.columns} <= set(checks)
    # Null tokens count as missing, which a test for null alone does not see.
    assert checks["populated:recipient_postal_code"] == 0


def test_audit_finds_faults(spark):
    """One wrong cell, one row lost, one added and one repeated, a column gone, kept and too many."""
    schema = "row_number long, amendment_number string, recipient_country string, coverage string, other string"
    df = spark.createDataFrame([(i, "0", None if i % 2 else "CA", "x", "o") for i in range(1, 9)], schema)
    treated = rm.remediate(df)
    good = {(r.column, r.action): r.cells for r in rm.remediation_audit(df, treated).collect()}
    assert good == {("recipient_country", "FILLED UNKNOWN"): 4, ("coverage", "DROPPED COLUMN"): 8}
    wrong = treated.withColumn("recipient_country", F.when(F.col("row_number") == 3, "US").otherwise(F.col("recipient_country")))
    odd = wrong.where("row_number <> 5").withColumn("coverage", F.lit("x")).withColumn("more", F.lit(1))
    odd = odd.unionByName(odd.where("row_number = 2").withColumn("row_number", F.lit(99).cast("long")))
    odd = odd.unionByName(odd.where("row_number = 4")).drop("recipient_country_was_missing")
    found = {(r.column, r.action): r.cells for r in rm.remediation_audit(df, odd).collect()}
    assert found == {
        ("recipient_country", "FILLED UNKNOWN"): 2,
        ("recipient_country", "UNEXPECTED VALUE"): 1,
        ("recipient_country_was_missing", "MISSING COLUMN"): 8,
        ("coverage", "NOT DROPPED"): 9,
        ("more", "EXTRA COLUMN"): 9,
        (None, "LOST ROW"): 1,
        (None, "ADDED ROW"): 1,
        (None, "REPEATED ROW"): 1,
    }
    none = {(r.column, r.action): r.cells for r in rm.remediation_audit(df, treated.where("false")).collect()}
    assert none == {("coverage", "DROPPED COLUMN"): 0, (None, "LOST ROW"): 8}


def test_audit_of_a_row_that_is_there_many_times(spark):
    """A third of the treated rows repeat one row: the join may be split, and all are counted."""
    df = spark.range(1, 20_001).select(F.col("id").alias("row_number"), F.lit("0").alias("amendment_number"), F.lit(None).cast("string").alias("recipient_country"))
    treated = rm.remediate(df)
    hot = treated.where("row_number = 7").withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(10_000)))).drop("_n")
    audit = rm.remediation_audit(df, treated.unionByName(hot))
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "LeftOuter" in plan
    found = {(r.column, r.action): r.cells for r in audit.collect()}
    assert found == {("recipient_country", "FILLED UNKNOWN"): 30_000, (None, "REPEATED ROW"): 10_000}


def test_audit_agrees_with_the_curated_table(spark, sf_dir):
    from fettle.plans.grants import grants

    view = grants(spark, sf_dir)
    curated = rm.curated_rows(rm.remediate(view))
    audit = rm.remediation_audit(view).collect()
    cells = defaultdict(int)
    for r in audit:
        if r.action.startswith(("FILLED", "STATUS")):
            cells[r.column] += r.cells
    for name in curated.columns:
        if name.endswith("_was_missing"):
            assert cells.get(name[: -len("_was_missing")], 0) == curated.where(name).count()
        if name.endswith("_status"):
            assert cells.get(name[: -len("_status")], 0) == curated.where(F.col(name).isNotNull()).count()
    dropped = [r.column for r in audit if r.action == "DROPPED COLUMN"]
    assert dropped == [c for c in view.columns if c not in curated.columns]


def test_mapping_never_multiplies_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "row_number long, name string")
    rows = [("a", "Y", "accepted"), ("a", "X", "accepted"), ("b", "b", "accepted"), ("b", "Z", "review")]
    mapping = spark.createDataFrame(rows, "original_value string, clean_value string, status string")
    clean = mp.apply_mapping(df, mapping, "name")
    assert sorted((r.row_number, r.name_clean) for r in clean.collect()) == [(1, "X"), (2, "b"), (3, None), (4, "X")]


def test_limits_need_an_order(spark):
    df = spark.createDataFrame([(1, "a")], "row_number long, v string")
    with pytest.raises(ValueError):
        se.search_report(df, "a")
    with pytest.raises(ValueError):
        se.top_rows(df, "gone")
    assert se.top_rows(df, "gone", order=["row_number"]).count() == 1


def test_sums_lose_no_value(spark):
    cells = ["1e33", "1e40", "0.1234567890123", "12.5", "inf", "x", None]
    for n, want in ((4, 1e40 + 1e33 + 12.5), (5, float("inf"))):
        rows = [(i, "term", v) for i, v in enumerate(cells[:n])]
        df = spark.createDataFrame(rows, "row_number long, owner_org string, agreement_value string")
        got = ev.lookup_totals(df, "term").first()
        assert (got.matched_rows, got.value_sum) == (n, want)
    small = spark.createDataFrame([(1, "term", "0.1234567890123")], "row_number long, owner_org string, agreement_value string")
    assert ev.lookup_totals(small, "term").first().value_sum == 0.1234567890123


def test_budget_ignores_null_texts(spark):
    items = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "k long, text string")
    got = ev.budget_concat(items, ["k"], budget=4).first()
    assert (got.text, got["items"]) == ("a\n\nb", 2)
