"""Settings as immutable values, passed explicitly; TOML files override the defaults."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field, fields, replace
from pathlib import Path

# Table ids looked for per form and group, in order.
PROFILES: dict[str, dict[str, list[str]]] = {
    "10-K": {
        "balance_sheets": [
            "consolidated_balance_sheets",
            "consolidated_statement_of_financial_position",
            "balance_sheets",
            "statement_of_financial_position",
            "balance_sheet",
        ],
        "income_statements": [
            "consolidated_statements_of_operations",
            "consolidated_statements_of_income",
            "statements_of_operations",
            "statements_of_income",
            "income_statements",
            "consolidated_statements_of_earnings",
            "statements_of_earnings",
            "consolidated_statements_of_comprehensive_income",
            "statements_of_comprehensive_income",
        ],
        "cash_flow_statements": [
            "consolidated_statements_of_cash_flows",
            "statements_of_cash_flows",
            "cash_flow_statements",
        ],
        "equity_statements": [
            "consolidated_statements_of_changes_in_equity",
            "statements_of_changes_in_equity",
            "consolidated_statements_of_stockholders_equity",
            "statements_of_stockholders_equity",
            "consolidated_statements_of_shareholders_equity",
            "statements_of_shareholders_equity",
            "consolidated_statements_of_redeemable_noncontrolling_interest_and_equity",
            "consolidated_statements_of_partners_equity",
            "statements_of_partners_equity",
            "consolidated_statements_of_members_equity",
            "statements_of_members_equity",
        ],
        "other_financial": [
            "financial_statements",
            "financial_highlights",
            "selected_financial_data",
            "financial_data",
            "ratio_of_earnings",
            "unaudited_quarterly_financial_data",
            "summary_of_significant_accounting_policies",
        ],
        "notes_and_supplements": [
            "notes_to_consolidated_financial_statements",
            "notes_to_financial_statements",
            "schedule_of_valuation_and_qualifying_accounts",
            "summary_of_quarterly_financial_data",
            "schedule_of_investee_earnings",
        ],
    },
    "10-Q": {
        "balance_sheets": [
            "consolidated_balance_sheets",
            "balance_sheets",
            "statement_of_financial_position",
            "consolidated_statement_of_financial_position",
        ],
        "income_statements": [
            "consolidated_statements_of_operations",
            "statements_of_operations",
            "consolidated_statements_of_income",
            "statements_of_income",
            "consolidated_statements_of_earnings",
            "statements_of_earnings",
            "consolidated_statements_of_comprehensive_income",
            "statements_of_comprehensive_income",
        ],
        "cash_flow_statements": [
            "consolidated_statements_of_cash_flows",
            "statements_of_cash_flows",
        ],
        "equity_statements": [
            "consolidated_statements_of_changes_in_equity",
            "statements_of_changes_in_equity",
            "consolidated_statements_of_stockholders_equity",
            "statements_of_stockholders_equity",
            "consolidated_statements_of_shareholders_equity",
            "statements_of_shareholders_equity",
        ],
        "management_discussion": [
            "management_discussion_and_analysis",
            "management_discussion",
        ],
    },
    "8-K": {
        "sections": [
            "financial_statements",
            "pro_forma_financial_information",
            "exhibits",
            "signature",
            "press_release",
            "material_agreement_table",
            "amendments_table",
        ],
    },
    "20-F": {
        "sections": [
            "consolidated_balance_sheets",
            "balance_sheets",
            "statement_of_financial_position",
            "consolidated_statements_of_operations",
            "statements_of_operations",
            "consolidated_statements_of_income",
            "statements_of_income",
            "consolidated_statements_of_comprehensive_income",
            "statements_of_comprehensive_income",
            "consolidated_statements_of_cash_flows",
            "statements_of_cash_flows",
            "consolidated_statements_of_changes_in_equity",
            "statements_of_changes_in_equity",
            "exchange_rates",
            "selected_financial_data",
            "operating_and_financial_review",
        ],
    },
}

# What a line of a plain-text table looks like.
TEXT_TABLE_PATTERNS = (r"^\s*[-+]{3,}\s+[-+]{3,}", r"^\s*[|]{1}\s+.*\s+[|]{1}$", r"^\s*\w+\s+\d+\s+\d+\s+\d+\s+\d+")


@dataclass(frozen=True)
class Settings:
    process_all_documents: bool = False
    default_ticker: str = "UNKNOWN"
    extract_html_tables: bool = True
    extract_text_tables: bool = True
    max_tables_per_document: int | None = None
    text_table_patterns: tuple[str, ...] = TEXT_TABLE_PATTERNS
    profiles: dict[str, tuple[str, ...]] = field(default_factory=lambda: {form: tuple(i for ids in groups.values() for i in ids) for form, groups in PROFILES.items()})
    download_folder: str = "filings"
    catalog_path: str = "catalog"
    log_level: str = "INFO"

    def table_ids(self, form: str | None) -> tuple[str, ...]:
        return self.profiles.get(form or "", ())


_FALLBACKS = ("config.toml", str(Path.home() / ".config/docketry/config.toml"))


def load_settings(path: str | None = None, **overrides) -> Settings:
    """The first readable TOML file of the given one and the usual places; none means the defaults."""
    found: dict = {}
    for candidate in filter(None, (path, *_FALLBACKS)):
        try:
            with open(candidate, "rb") as f:
                found = tomllib.load(f)
            break
        except (OSError, tomllib.TOMLDecodeError):
            continue
    known = {f.name for f in fields(Settings)}
    values = {k: v for k, v in found.get("docketry", found).items() if k in known}
    if isinstance(values.get("profiles"), dict):
        values["profiles"] = {form: tuple(i for ids in groups.values() for i in ids) if isinstance(groups, dict) else tuple(groups) for form, groups in values["profiles"].items()}
    if "text_table_patterns" in values:
        values["text_table_patterns"] = tuple(values["text_table_patterns"])
    return replace(Settings(**values), **{k: v for k, v in overrides.items() if v is not None})


def profile_rows(settings: Settings) -> list[tuple[str, int, str]]:
    """(form, ord, table_id): the profile dimension."""
    return [(form, k, i) for form, ids in settings.profiles.items() for k, i in enumerate(ids)]
