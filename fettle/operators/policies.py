"""Treatments for incomplete columns of the grants table."""

from __future__ import annotations

from dataclasses import dataclass

# Kinds of treatment that a policy can ask for.
DROP = "drop"
FILL = "fill"
STATUS = "status"
DEPENDENT_DATE = "dependent date"
DEPENDENT_FILL = "dependent fill"


@dataclass(frozen=True)
class Policy:
    """What to do with some columns: the texts for the plan and the values for the run.

    ``fill`` replaces a missing cell; with ``flag`` a Boolean ``<column>_was_missing`` is
    added, with ``keep_raw`` the untouched value stays as ``<column>_raw``. For the status
    kind the cell stays null and ``<column>_status`` gets the value. The dependent kinds look at
    ``depends_on``: they use ``fill`` or ``otherwise`` by whether it differs from ``expected``.
    """

    columns: tuple[str, ...]
    decision: str
    treatment: str
    reason: str
    kind: str = FILL
    fill: str = ""
    flag: bool = False
    keep_raw: bool = False
    depends_on: str = ""
    expected: str = ""
    otherwise: str = ""


# Decision, treatment and reason of each policy are report texts.
POLICIES = (
    Policy(
        columns=(
            "coverage",
            "federal_riding_number",
            "federal_riding_name_en",
            "federal_riding_name_fr",
        ),
        decision="DELETE COLUMN",
        treatment="Remove from the analytical table; retain only in the immutable raw snapshot.",
        reason="Essentially empty and not reliable enough for analysis or imputation.",
        kind=DROP,
    ),
    Policy(
        columns=("amendment_date",),
        decision="SET FIXED VALUE CONDITIONALLY",
        treatment="When amendment_number = 0, expose NOT_APPLICABLE in a text/status field. If amendment_number > 0 and the date is missing, reject the row for data-quality review.",
        reason="A missing date is expected for a non-amendment but invalid for an amendment.",
        kind=DEPENDENT_DATE,
        fill="NOT_APPLICABLE",
        depends_on="amendment_number",
        expected="0",
    ),
    Policy(
        columns=("recipient_operating_name", "research_organization_name"),
        decision="SET FIXED VALUE",
        treatment="Set missing text to NOT_PROVIDED and add a Boolean was_missing flag.",
        reason="These optional names remain useful when supplied; inventing a name would create a false entity.",
        fill="NOT_PROVIDED",
        flag=True,
    ),
    Policy(
        columns=("foreign_currency_type",),
        decision="SET FIXED VALUE",
        treatment="Set missing text to NOT_APPLICABLE; do not assume CAD from frequency alone.",
        reason="The field is an optional currency detail and mode imputation could misclassify an agreement.",
        fill="NOT_APPLICABLE",
    ),
    Policy(
        columns=("foreign_currency_value",),
        decision="SET FIXED STATUS VALUE",
        treatment="Keep the numeric value NULL and set foreign_currency_value_status to NOT_APPLICABLE. Never replace it with 0.",
        reason="Zero is a real monetary amount; a status field preserves numeric type and null meaning.",
        kind=STATUS,
        fill="NOT_APPLICABLE",
    ),
    Policy(
        columns=("naics_identifier", "recipient_business_number"),
        decision="SET FIXED VALUE",
        treatment="Store as text and set missing identifiers to NOT_PROVIDED with a was_missing flag.",
        reason="Identifiers are categorical keys, so mean, median, and mode imputation are invalid.",
        fill="NOT_PROVIDED",
        flag=True,
    ),
    Policy(
        columns=("recipient_type", "agreement_type"),
        decision="SET FIXED VALUE",
        treatment="Set missing category codes to UNKNOWN and retain the original raw value separately.",
        reason="UNKNOWN is an explicit controlled category and avoids guessing a business classification.",
        fill="UNKNOWN",
        keep_raw=True,
    ),
    Policy(
        columns=(
            "additional_information_fr",
            "additional_information_en",
            "prog_purpose_fr",
            "prog_purpose_en",
            "expected_results_fr",
            "expected_results_en",
            "agreement_title_fr",
            "agreement_title_en",
            "prog_name_en",
            "prog_name_fr",
            "description_en",
            "description_fr",
        ),
        decision="SET FIXED VALUE",
        treatment="Set missing narrative text to NOT_PROVIDED and add a was_missing flag.",
        reason="Free text and bilingual content cannot be reconstructed reliably with statistical imputation.",
        fill="NOT_PROVIDED",
        flag=True,
    ),
    Policy(
        columns=("recipient_postal_code", "agreement_number"),
        decision="SET FIXED VALUE",
        treatment="Store as text and set missing values to NOT_PROVIDED with a was_missing flag.",
        reason="These are identifiers, not measurements; fabricated or modal values would create false matches.",
        fill="NOT_PROVIDED",
        flag=True,
    ),
    Policy(
        columns=("agreement_end_date",),
        decision="SET FIXED STATUS VALUE",
        treatment="Keep the date NULL and set agreement_end_date_status to NOT_PROVIDED. Do not copy the start date or invent a duration.",
        reason="A sentinel string would break the date type and a guessed end date would distort durations.",
        kind=STATUS,
        fill="NOT_PROVIDED",
    ),
    Policy(
        columns=("recipient_province",),
        decision="SET FIXED VALUE CONDITIONALLY",
        treatment="Set NOT_APPLICABLE when recipient_country is not CA; otherwise set UNKNOWN. Add a was_missing flag.",
        reason="Province is structurally inapplicable outside Canada but unknown for an incomplete Canadian address.",
        kind=DEPENDENT_FILL,
        fill="NOT_APPLICABLE",
        flag=True,
        depends_on="recipient_country",
        expected="CA",
        otherwise="UNKNOWN",
    ),
    Policy(
        columns=("recipient_country", "recipient_city"),
        decision="SET FIXED VALUE",
        treatment="Set missing text to UNKNOWN and add a was_missing flag; do not use the most frequent value.",
        reason="Even at low missingness, mode imputation can assign a real agreement to the wrong location.",
        fill="UNKNOWN",
        flag=True,
    ),
)

# The treatment of an incomplete column that no policy lists.
DEFAULT_POLICY = Policy(
    columns=(),
    decision="SET FIXED VALUE",
    treatment="Set missing text to UNKNOWN and add a was_missing flag.",
    reason="No trustworthy deterministic source is available for imputation.",
    fill="UNKNOWN",
    flag=True,
)
