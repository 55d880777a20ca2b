import compare
import pytest

import __spark_entry__ as entry
from fettle.plans import oracles, registry

QUERIES = registry.queries()
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare.compare(spark, con, sf_dir, name, QUERIES[name], SQL.get(name)) == ""


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert sorted(set(QUERIES) - set(SQL)) == ["file_overview"]
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert [r.colonne for r in rows][:2] == ["coverage", "amendment_date"] and len(rows) == 18


def test_known_figures(spark, sf_dir):
    """Figures worked out beforehand for the smallest data set."""
    if not sf_dir.endswith("sf0.001"):
        pytest.skip("figures are for sf0.001")
    missing = {r.colonne: r.valeurs_manquantes for r in QUERIES["missing_report"](spark, sf_dir).collect()}
    assert {c: n for c, n in missing.items() if n} == {
        "coverage": 1499, "amendment_date": 1450, "recipient_operating_name": 1425,
        "foreign_currency_type": 1384, "foreign_currency_value": 1384, "recipient_type": 1125,
        "recipient_postal_code": 559, "agreement_end_date": 375, "recipient_province": 282,
        "recipient_country": 3, "agreement_type": 2}
    dups = [tuple(r) for r in QUERIES["dup_summary"](spark, sf_dir).collect()]
    assert dups == [("ref_number", 75, 75), ("org_city_postal", 52, 54), ("org_date_value", 9, 9)]
    status = {r.status: r["count"] for r in QUERIES["mapping_status"](spark, sf_dir).collect()}
    assert status == {"accepted": 130, "review": 27, "rejected": 24}
    facts = {r.metric: r.value for r in QUERIES["final_summary"](spark, sf_dir).collect()}
    assert facts["rows"] == 1500 and facts["distinct_raw"] == 181 and facts["corrections_applied"] == 843
    assert QUERIES["amendment_review"](spark, sf_dir).count() == 25
