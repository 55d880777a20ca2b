"""The registered queries: each takes a session and a data folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fettle.functions.alias import accept_alias, review_candidate
from fettle.functions.nulls import canonical_null, null_to_empty
from fettle.functions.rows import as_rows, beside
from fettle.functions.shapes import date_shape, exact_sum, numeric_shape, to_number
from fettle.functions.text import collapse_segments, compact_text, normalize_text
from fettle.functions.tokens import any_contains, lookup_term, token_set
from fettle.operators import duplicates as dup
from fettle.operators import evidence as ev
from fettle.operators import mapping as mp
from fettle.operators import profile as pr
from fettle.operators import remediation as rm
from fettle.operators import search as se
from fettle.operators import summary as sm
from fettle.operators import variants as va
from fettle.plans.grants import COLUMNS, grants, numbered_grants, table
from fettle.operators.policies import DEFAULT_POLICY, POLICIES
from fettle.plans.session import tune, work_path
from fettle.plans.views import (
    COPY_OFFSET,
    documents_with_figures,
    grants_with_copies,
    questions,
    read_grants,
    sectioned_documents,
)
from fettle.sources import tables as src
from fettle.sources.positions import read_csv_numbered, read_parquet_numbered

Query = Callable[[SparkSession, str], DataFrame]

TARGET = "recipient_legal_name"
QUESTION = "Which duplicate values of blue GEAR have most Notes in the report?"
REPORT_QUESTION = "Why is blue gear in review, and which accepted COOP UQAM forms remain?"
TERM = "uqam"
PREVIEW_COLUMNS = [
    "ref_number",
    "recipient_legal_name",
    "recipient_legal_name_clean",
    "recipient_city",
    "recipient_province",
    "agreement_value",
    "agreement_start_date",
]
SAMPLE_COLUMNS = [
    "recipient_legal_name",
    "recipient_legal_name_clean",
    "recipient_city",
    "agreement_value",
]
# A policy set without postal codes: that column then takes the default treatment.
SOME_POLICIES = [p for p in POLICIES if "recipient_postal_code" not in p.columns]
UNLISTED = ["recipient_postal_code"]

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    # The view is wide: in a session as it comes, its generated code would never be compiled.
    _QUERIES[fn.__name__] = lambda spark, sf_dir: fn(tune(spark), sf_dir.rstrip("/"))
    return fn


# Shared intermediate results


def _variants(read):
    return va.variants_report(read, TARGET)


def _mapping(read):
    return mp.build_mapping(_variants(read))


def _cleaned(read):
    return mp.apply_mapping(read, _mapping(read), TARGET)


def _cleaned_with(rows, mapping):
    return mp.apply_mapping(rows, mapping, TARGET)


def _cleaned_for(read, term):
    """The table with those clean names that contain a term; for a lookup of that term.

    The few labels are searched before the join, and the raw cells are searched anyway.
    """
    labels = mp.effective(_mapping(read)).where(any_contains([F.col("clean_value")], term))
    return mp.apply_mapping(read, labels.withColumn("status", F.lit("accepted")), TARGET)


def _duplicates(spark, sf, rules=dup.DEFAULT_RULES, ordered=True):
    return dup.duplicate_report(grants(spark, sf), rules, exclude=["row_number"], ordered=ordered)


def _saved_variants(spark, sf):
    """The variants report, written once for all that is made from it."""
    return src.write_snapshot(_variants(read_grants(spark, sf)), work_path(spark, "variants"))


def _reports(spark, sf):
    """Name, rows and order of the four reports, each written once."""
    found = _saved_variants(spark, sf)
    made = [
        ("missing_values", pr.missing_report(grants(spark, sf), ordered=False), ["colonne"]),
        ("duplicates", _duplicates(spark, sf, ordered=False), ["duplicate_type", "sample_row_number"]),
        ("organization_variants", found, ["original_value"]),
        ("entity_cleaning_mapping", mp.build_mapping(found), ["original_value"]),
    ]
    saved = {name: src.write_snapshot(rows, work_path(spark, name)) for name, rows, _ in made if rows is not found}
    return [(name, saved.get(name, rows), order) for name, rows, order in made]


def _groups(view):
    """Duplicate groups without samples: all that the summaries need."""
    return dup.duplicate_groups(canonical_null(view).transform(null_to_empty))


def _names(spark, sf):
    return va.value_counts(read_grants(spark, sf), TARGET, "row_number")


# Sources


@query
def row_numbers(spark, sf):
    """Dense position of every row by a unique key."""
    return numbered_grants(spark, sf)


@query
def source_row_numbers(spark, sf):
    """Position of every row in a Parquet table, from the scan itself."""
    return read_parquet_numbered(spark, f"{sf}/orders.parquet")


@query
def sample_rows(spark, sf):
    """First thousand rows in source order."""
    return src.sample_rows(grants(spark, sf), 1000, "row_number", list(COLUMNS))


@query
def dataset_overview(spark, sf):
    """Rows and columns of the grants view."""
    return src.dataset_overview(grants(spark, sf))


@query
def file_overview(spark, sf):
    """Bytes, files, rows and columns of a table on disk."""
    return src.file_overview(table(spark, sf, "lineitem"))


@query
def files_overview(spark, sf):
    """Files, rows and columns of orders in three files, and a fourth without rows."""
    path, orders = work_path(spark, "orders-files"), table(spark, sf, "orders")
    orders.repartition(3).write.parquet(path)
    orders.limit(0).write.mode("append").parquet(path)
    return src.files_overview(spark.read.parquet(path)).drop("bytes")


@query
def text_scan(spark, sf):
    """Write the grants view as CSV, read its columns back as text."""
    path = work_path(spark, "grants-csv")
    src.write_report(src.to_text_snapshot(grants(spark, sf)), path)
    return src.read_text_table(spark, path, list(COLUMNS))


@query
def csv_row_numbers(spark, sf):
    """Write orders as CSV in key order, read them back numbered by place."""
    path = work_path(spark, "orders-csv")
    text = src.to_text_snapshot(table(spark, sf, "orders").orderBy("o_orderkey"))
    src.write_report(text, path)
    return read_csv_numbered(spark, path)


@query
def csv_line_breaks(spark, sf):
    """Write whole texts, with their line breaks, as CSV; read the records back numbered."""
    path = work_path(spark, "documents-csv")
    src.write_report(table(spark, sf, "documents").orderBy("doc_id"), path)
    return read_csv_numbered(spark, path)


@query
def missing_input(spark, sf):
    """A report that was never written is an empty relation of its columns."""
    found = src.read_report(spark, work_path(spark, "never-written"), "colonne string, total_lignes bigint")
    return found.unionByName(pr.missing_report(grants(spark, sf)).select("colonne", "total_lignes"))


@query
def target_fallback(spark, sf):
    """Values of the first column, as the table lacks the wanted one."""
    view = read_grants(spark, sf).select("ref_number", "recipient_city")
    return va.value_counts(view, src.resolve_target(view, "owner_name")).select("original_value", "count")


@query
def snapshot_scan(spark, sf):
    """Write the text snapshot of orders once and reuse it."""
    path = work_path(spark, "orders-text")
    text = src.to_text_snapshot(table(spark, sf, "orders"))
    src.write_snapshot(text, path)
    return src.write_snapshot(text, path)


@query
def text_snapshot_orders(spark, sf):
    """Typed cells as stable text: midnight timestamps show as dates."""
    return src.to_text_snapshot(table(spark, sf, "orders"))


@query
def text_snapshot_events(spark, sf):
    """Typed cells as stable text: other timestamps keep their microseconds."""
    return src.to_text_snapshot(table(spark, sf, "events"))


@query
def canonical_nulls(spark, sf):
    """Null tokens and blank cells as null, for every row."""
    return canonical_null(grants(spark, sf)).withColumnRenamed("row_number", "key")


@query
def blank_preserving_nulls(spark, sf):
    """Null tokens as null while blank cells stay, then nulls as empty text."""
    read = canonical_null(grants(spark, sf), blanks=False)
    return null_to_empty(read).withColumnRenamed("row_number", "key")


# Profile


@query
def missing_report(spark, sf):
    return pr.missing_report(grants(spark, sf))


@query
def missing_profile(spark, sf):
    return pr.missing_profile(grants(spark, sf))


@query
def completeness(spark, sf):
    return pr.completeness(grants(spark, sf))


@query
def missing_range_filter(spark, sf):
    return se.filter_range(pr.missing_report(grants(spark, sf)), "pourcentage_manquant")


@query
def top_missing(spark, sf):
    """The ten worst columns."""
    return (
        pr.missing_report(grants(spark, sf))
        .limit(10)
        .select("colonne", "pourcentage_manquant", "recommandation")
    )


@query
def remediation_plan(spark, sf):
    return pr.remediation_plan(grants(spark, sf), SOME_POLICIES, DEFAULT_POLICY)


@query
def column_roles(spark, sf):
    return pr.column_roles(grants(spark, sf), "row_number")


@query
def column_dtypes(spark, sf):
    return pr.column_dtypes(grants(spark, sf), "row_number")


@query
def column_roles_sample(spark, sf):
    """Roles from the first thousand rows."""
    return pr.column_roles(grants(spark, sf), "row_number", 1000)


@query
def column_dtypes_sample(spark, sf):
    """Types from the first thousand rows."""
    return pr.column_dtypes(grants(spark, sf), "row_number", 1000)


@query
def shape_counts(spark, sf):
    """Cells per column that look like a date or a number, and the sum of the numbers."""
    cols = ["ref_number", "amendment_number", "agreement_value", "agreement_start_date"]
    # One aggregate over the wide rows; only its single row is turned into one row per column.
    tests, rows = [], []
    for c in cols:
        tests += [
            F.count_if(date_shape(F.col(c))).alias(f"{c}_dates"),
            F.count_if(numeric_shape(F.col(c))).alias(f"{c}_numbers"),
            exact_sum(to_number(F.col(c))).alias(f"{c}_total"),
        ]
        rows.append((F.lit(c), *[F.col(f"{c}_{k}") for k in ("dates", "numbers", "total")]))
    return (
        grants(spark, sf).agg(*tests).select(as_rows(["column", "dates", "numbers", "total"], rows))
    )


# Duplicates


@query
def dup_exact(spark, sf):
    """Whole-row duplicates; the row number is not part of the row."""
    return dup.duplicate_report(
        grants_with_copies(spark, sf), [dup.EXACT_ROW], exclude=["row_number"]
    )


@query
def dup_ref(spark, sf):
    return _duplicates(spark, sf, [dup.REF_NUMBER])


@query
def dup_org_date_value(spark, sf):
    return _duplicates(spark, sf, [dup.ORG_DATE_VALUE])


@query
def dup_org_city_postal(spark, sf):
    return _duplicates(spark, sf, [dup.ORG_CITY_POSTAL])


@query
def dup_report(spark, sf):
    return _duplicates(spark, sf)


@query
def dup_by_rule(spark, sf):
    """First 200 groups of one rule, in report order."""
    found = _duplicates(spark, sf, [dup.ORG_CITY_POSTAL])
    return se.filter_value(found, "duplicate_type", "org_city_postal").limit(200)


@query
def dup_lineitem(spark, sf):
    """Repeated part and supplier pairs."""
    rule = dup.KeyRule("part_supplier", (("part", "l_partkey"), ("supplier", "l_suppkey")))
    items = read_parquet_numbered(spark, f"{sf}/lineitem.parquet")
    return dup.duplicate_groups(items.select("row_number", "l_partkey", "l_suppkey"), [rule])


@query
def dup_documents(spark, sf):
    """Texts that occur more than once, by whole text."""
    docs = canonical_null(table(spark, sf, "documents").select("doc_id", "text")).transform(null_to_empty)
    return dup.duplicate_groups(docs, [dup.EXACT_ROW], "doc_id", exclude=["doc_id"])


@query
def dup_summary(spark, sf):
    return dup.duplicate_summary(_groups(grants(spark, sf)))


@query
def dup_summary_max(spark, sf):
    return dup.duplicate_summary(_groups(grants(spark, sf)), with_max=True)


@query
def dup_total(spark, sf):
    return dup.total_flagged(_groups(grants(spark, sf)))


# Text


@query
def value_counts(spark, sf):
    return va.value_counts(read_grants(spark, sf), TARGET).select("original_value", "count")


@query
def distinct_counts(spark, sf):
    return va.distinct_counts(
        read_grants(spark, sf), [TARGET, "recipient_city", "recipient_postal_code"]
    )


@query
def normalize_documents(spark, sf):
    """Normal form of whole texts."""
    normal = normalize_text(F.col("text"))
    return (
        table(spark, sf, "documents")
        .select("doc_id", normal.alias("normal"))
        .select("doc_id", F.char_length("normal").alias("length"), F.md5("normal").alias("digest"))
    )


@query
def compact_documents(spark, sf):
    """Compact form of whole texts."""
    compact = compact_text(F.col("text"))
    return (
        table(spark, sf, "documents")
        .select("doc_id", compact.alias("compact"))
        .select("doc_id", F.char_length("compact").alias("length"), F.md5("compact").alias("digest"))
    )


@query
def collapse_segments_names(spark, sf):
    return _names(spark, sf).select(
        "original_value", collapse_segments(F.col("original_value")).alias("collapsed_value")
    )


@query
def name_forms(spark, sf):
    return va.name_forms(_names(spark, sf)).select(
        "original_value", "collapsed_value", "normalized_value", "compact_value", "full_normalized"
    )


@query
def compact_groups(spark, sf):
    """Members and canonical label of each compact form."""
    return va.compact_groups(va.name_forms(_names(spark, sf))).select(
        "compact_value", "members", "canonical", "group_family"
    )


@query
def alias_flags(spark, sf):
    name = F.col("original_value")
    return _names(spark, sf).select(
        "original_value",
        accept_alias(name).alias("accepted"),
        review_candidate(name).alias("review"),
    )


@query
def fuzzy_scores(spark, sf):
    return va.scored_names(_names(spark, sf)).select(
        "original_value", "suggested_group", "similarity_score", "decision"
    )


# Variants, mapping, cleaning


@query
def variants_report(spark, sf):
    """In report order, with the place of each row in it."""
    return _variants(read_grants(spark, sf)).orderBy(*va.report_order())


@query
def cleaning_mapping(spark, sf):
    return _mapping(read_grants(spark, sf))


@query
def accepted_mapping(spark, sf):
    return mp.accepted_only(_mapping(read_grants(spark, sf)))


@query
def cleaned_table(spark, sf):
    return _cleaned(read_grants(spark, sf)).withColumnRenamed("row_number", "key")


@query
def cleaned_from_saved(spark, sf):
    """Clean with a saved report that a reviewer added rows to: the first row of a name counts."""
    read, path = read_grants(spark, sf), work_path(spark, "variants")
    found = _variants(read)
    # The reviewer repeats the rejected names, with another label and fewer rows.
    edited = found.where("decision = 'rejected'").select(
        "original_value",
        "normalized_value",
        F.lit("EDITED").alias("suggested_group"),
        "similarity_score",
        (F.col("count") - 1).alias("count"),
        F.lit("accepted").alias("decision"),
    )
    src.write_report(found.unionByName(edited), path)
    saved = src.read_report(spark, path, found.schema)
    mapping = mp.build_mapping(saved, unique=False)
    clean = mp.apply_mapping(read, mapping, TARGET)
    return clean.withColumnRenamed("row_number", "key")


@query
def changed_cells(spark, sf):
    return mp.changed_count(_cleaned(read_grants(spark, sf)), TARGET, f"{TARGET}_clean")


@query
def cleaning_execution(spark, sf):
    read = read_grants(spark, sf)
    return mp.cleaning_summary(read, _mapping(read), TARGET)


@query
def mapping_status(spark, sf):
    return mp.mapping_summary(_mapping(read_grants(spark, sf)))


@query
def mapping_review_count(spark, sf):
    return mp.review_count(_mapping(read_grants(spark, sf)))


# Search


@query
def search_any_column(spark, sf):
    """Rows of the missing report with a text in any column."""
    report = pr.missing_report(grants(spark, sf))
    order = [F.desc("pourcentage_manquant"), F.desc("valeurs_manquantes"), "colonne"]
    return se.search_report(report, "Recipient", 200, order=order)


@query
def search_blank(spark, sf):
    """A blank text keeps every row of a report."""
    return se.search_report(pr.missing_report(grants(spark, sf)), "  ", None)


@query
def search_mapping(spark, sf):
    found = se.filter_value(_mapping(read_grants(spark, sf)), "status", "accepted")
    return se.search_report(found, "Ring", 500, order=["original_value"])


@query
def search_variants(spark, sf):
    return se.search_report(
        _variants(read_grants(spark, sf)), "gear", None, ("decision", "All"), order=va.report_order()
    )


@query
def decision_counts(spark, sf):
    """Rows per decision among the variants that match a search."""
    return va.decision_counts(se.search_report(_variants(read_grants(spark, sf)), "UQAM", None))


@query
def search_table(spark, sf):
    """First matches in source order over the whole table."""
    cols = ["ref_number", "recipient_legal_name", "recipient_city", "owner_org"]
    return se.search_table(read_grants(spark, sf), "NATION_7", cols, 100)


@query
def search_snapshot(spark, sf):
    """First matches in a numbered snapshot: it is read from the start until there are enough."""
    text = src.to_text_snapshot(read_parquet_numbered(spark, f"{sf}/orders.parquet"))
    numbered = text.withColumn("row_number", F.col("row_number").cast("bigint"))
    saved = src.write_snapshot(numbered, work_path(spark, "numbered"))
    return se.search_table(saved, "URGENT", saved.columns, 100, numbered=True)


@query
def top_rows(spark, sf):
    """Rows with the largest foreign currency value, read as a number."""
    view = read_grants(spark, sf)
    found = se.top_rows(view, "foreign_currency_value", 20, order=["row_number"])
    return found.withColumnRenamed("row_number", "key")


@query
def raw_clean_preview(spark, sf):
    """The same search on the raw and the cleaned table, side by side."""
    read, mapping = read_grants(spark, sf), mp.build_mapping(_saved_variants(spark, sf))
    # The labels with the term suffice to find the rows; the rows shown get all labels.
    labels = mp.effective(mapping).where(any_contains([F.col("clean_value")], TERM))
    found = se.preview(read, _cleaned_with(read, labels.withColumn("status", F.lit("accepted"))), TERM, PREVIEW_COLUMNS, 40)
    shown = _cleaned_with(found.drop(f"{TARGET}_clean"), mapping)
    clean = F.when(F.col("side") == "clean", F.col(f"{TARGET}_clean")).alias(f"{TARGET}_clean")
    return shown.select(*[clean if c == f"{TARGET}_clean" else c for c in found.columns]).withColumnRenamed("row_number", "key")


@query
def cleaned_sample(spark, sf):
    """First rows of the cleaned table."""
    read = read_grants(spark, sf)
    return src.sample_rows(_cleaned_with(src.sample_rows(read, 20, "row_number"), _mapping(read)), 20, "row_number", SAMPLE_COLUMNS)


# Evidence


@query
def lookup_terms(spark, sf):
    """What each conversation turn asks about."""
    return questions(spark, sf).select(
        "conv_id", "turn", lookup_term(F.col("question")).alias("term")
    )


@query
def lookup_totals(spark, sf):
    """Rows of the cleaned table that contain a term, and the sum of their values."""
    return ev.lookup_totals(_cleaned_for(read_grants(spark, sf), TERM), TERM)


@query
def lookup_extremes(spark, sf):
    """The same over values that no decimal holds, and with many digits."""
    odd = (
        F.when(F.col("row_number") % 7 == 0, F.lit("1e33"))
        .when(F.col("row_number") % 7 == 1, F.lit("1e40"))
        .when(F.col("row_number") % 7 == 2, F.lit("0.1234567890123"))
        .otherwise(F.col("agreement_value"))
    )
    return ev.lookup_totals(read_grants(spark, sf).withColumn("agreement_value", odd), TERM)


@query
def lookup_no_term(spark, sf):
    """Questions without a term match nothing: how many there are, and their totals."""
    asked = questions(spark, sf).where(lookup_term(F.col("question")) == "")
    none = ev.lookup_totals(read_grants(spark, sf), "")
    return beside(asked.agg(F.count(F.lit(1)).alias("questions")), none)


@query
def lookup_rows(spark, sf):
    read = read_grants(spark, sf)
    found = ev.lookup_rows(_cleaned_for(read, TERM), TERM, ["row_number", *ev.LOOKUP_COLUMNS])
    # The eight rows then get their clean name from the whole mapping.
    shown = src.existing(found, ev.LOOKUP_COLUMNS)
    return _cleaned_with(found.drop(f"{TARGET}_clean"), _mapping(read)).select(*shown)


@query
def token_sets(spark, sf):
    """Distinct words of whole texts."""
    tokens = F.sort_array(token_set(F.col("text")))
    return (
        table(spark, sf, "documents")
        .select("doc_id", tokens.alias("tokens"))
        .select(
            "doc_id",
            F.size("tokens").alias("words"),
            F.md5(F.array_join("tokens", " ")).alias("digest"),
        )
    )


@query
def text_sections(spark, sf):
    """Sections of whole texts, in windows."""
    sections = ev.split_sections(sectioned_documents(spark, sf), ["doc_id"], "content", "doc_id")
    return sections.select("doc_id", "section", "part", "label", F.md5("chunk").alias("digest"))


@query
def top_sections(spark, sf):
    """The two best sections of each text for a question."""
    sections = ev.split_sections(sectioned_documents(spark, sf), ["doc_id"], "content", "doc_id")
    return ev.top_sections(sections, ["doc_id"], QUESTION, 2).select(
        "doc_id", "rank", "score", "label", F.md5("chunk").alias("digest")
    )


@query
def row_relevance(spark, sf):
    """Mapping rows that answer a question best."""
    return ev.relevant_rows(_mapping(read_grants(spark, sf)), REPORT_QUESTION, 6, order=["original_value"])


@query
def report_summary(spark, sf):
    """Rows, columns and most frequent values of the four reports."""
    found = [pr.report_summary(r).withColumn("report", F.lit(n)) for n, r, _ in _reports(spark, sf)]
    return reduce(DataFrame.unionByName, found)


@query
def value_profile(spark, sf):
    """Most frequent values of two columns of the variants report."""
    return pr.value_profile(_variants(read_grants(spark, sf)), ["decision", "suggested_group"], 12)


@query
def budget_concat(spark, sf):
    """Texts joined in order until the character budget is used."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return ev.budget_concat(ev.enough_documents(docs, "doc_id", lambda part: part), ["doc_id"])


@query
def evidence_bundle(spark, sf):
    """Bounded text over all reports and texts, its sources, and the number of matching rows."""
    def best_of(docs):
        sections = ev.split_sections(docs, ["doc_id"], "content", "doc_id")
        return ev.top_sections(sections, ["doc_id"], REPORT_QUESTION, 2)

    # Of the texts only as many are read, in order, as fill the budget.
    docs = sectioned_documents(spark, sf)
    best = best_of(ev.enough_documents(docs, "doc_id", lambda part: best_of(part).select(ev.section_text().alias("text"))))
    totals = ev.lookup_totals(read_grants(spark, sf), TERM)
    reports = _reports(spark, sf)
    figures = src.dataset_overview(grants(spark, sf))
    items = ev.gather_evidence(REPORT_QUESTION, figures, totals.select("matched_rows"), reports, best, "doc_id")
    # Every report is made once, for the lengths and the texts that fit.
    items = src.write_snapshot(items, work_path(spark, "evidence"))
    bundle = ev.evidence_bundle(items, [*[n for n, _, _ in reports], "documents"], totals)
    return bundle.withColumn("sources", F.array_join("sources", ","))


@query
def report_metrics(spark, sf):
    """Figures quoted in whole texts."""
    return ev.extract_metrics(documents_with_figures(spark, sf), "content", ["doc_id"])


# Summary


@query
def final_summary(spark, sf):
    view = grants(spark, sf)
    mapping = mp.build_mapping(_saved_variants(spark, sf))
    return sm.final_summary(canonical_null(view, blanks=False), _groups(view), mapping, TARGET)


# Remediation


@query
def remediated_table(spark, sf):
    treated = rm.remediate(grants(spark, sf), SOME_POLICIES, UNLISTED)
    return rm.curated_rows(treated).withColumnRenamed("row_number", "key")


@query
def amendment_review(spark, sf):
    """Amendments without a date, held for a person."""
    return rm.review_rows(grants(spark, sf)).withColumnRenamed("row_number", "key")


@query
def remediation_checks(spark, sf):
    view = grants(spark, sf)
    treated = rm.remediate(view, SOME_POLICIES, UNLISTED)
    return rm.remediation_checks(view, treated, SOME_POLICIES, UNLISTED)


@query
def remediation_profile(spark, sf):
    """Missing values per column before and after treatment."""
    view = grants(spark, sf)
    return rm.remediation_profile(view, rm.remediate(view, SOME_POLICIES, UNLISTED), SOME_POLICIES, UNLISTED)


@query
def remediation_audit(spark, sf):
    """What the treated table shows, cell by cell."""
    view = grants(spark, sf)
    return rm.remediation_audit(view, rm.remediate(view, SOME_POLICIES, UNLISTED), SOME_POLICIES, UNLISTED)


@query
def remediation_shipped(spark, sf):
    """The audit under all policies as shipped; nothing is left to the default."""
    view = grants(spark, sf)
    return rm.remediation_audit(view, rm.remediate(view))


@query
def remediation_planned(spark, sf):
    """What the policy says will be done, from the table before alone."""
    return rm.planned_changes(grants(spark, sf), SOME_POLICIES, UNLISTED)


def faulty(treated):
    """A treated table with rows lost, added and repeated, wrong and unfilled cells."""
    n = F.col("row_number")
    kept = treated.where(n % 101 != 7)
    wrong = kept.withColumns(
        {
            "recipient_city": F.when(n % 83 == 1, "ELSEWHERE").otherwise(F.col("recipient_city")),
            "recipient_country": F.when(~F.col("recipient_country_was_missing"), F.col("recipient_country")),
            "agreement_value": F.when(n % 79 == 0, F.lit(None)).otherwise(F.col("agreement_value")),
            "remark": F.when(n % 71 == 0, "by hand"),
        }
    ).drop("foreign_currency_value_status")
    added = wrong.where(n % 97 == 5).withColumn("row_number", n + COPY_OFFSET)
    return wrong.unionByName(added).unionByName(wrong.where(n % 89 == 3))


@query
def remediation_faults(spark, sf):
    """The audit of a table that was treated badly."""
    view = grants(spark, sf)
    return rm.remediation_audit(view, faulty(rm.remediate(view, SOME_POLICIES, UNLISTED)), SOME_POLICIES, UNLISTED)


@query
def remediated_detected(spark, sf):
    """The curated table with the columns that need the default found by the profile."""
    view = grants(spark, sf)
    treated = rm.remediate(view, SOME_POLICIES, rm.unlisted_incomplete(view, SOME_POLICIES))
    return rm.curated_rows(treated).withColumnRenamed("row_number", "key")


@query
def remediation_log(spark, sf):
    """Every touched cell."""
    log = rm.remediation_log(grants(spark, sf), SOME_POLICIES, UNLISTED)
    return log.withColumnRenamed("row_number", "key")


def queries() -> dict[str, Query]:
    """All registered queries by name."""
    return dict(_QUERIES)
