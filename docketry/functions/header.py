"""Header and block fields as Column expressions (HDR, DOC, TKR).

Patterns carry (?U) so that white space, digits and word characters are Unicode's, and (?d) so that only a
line feed ends a line. No match is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_CHARS, WINDOW_CHARS = 2000, 10000

# Label of each header field and the shape of what follows it.
TOKEN, DIGITS, LINE = r"\s+(\S+)", r"\s+(\d+)", r"\s+(.+?)$"
FLAT = {"accession_number": ("ACCESSION NUMBER", TOKEN), "conformed_period_of_report": ("CONFORMED PERIOD OF REPORT", TOKEN), "filed_as_of_date": ("FILED AS OF DATE", TOKEN), "date_as_of_change": ("DATE AS OF CHANGE", TOKEN), "effectiveness_date": ("EFFECTIVENESS DATE", TOKEN)}
COMPANY = {"company_conformed_name": ("COMPANY CONFORMED NAME", LINE), "central_index_key": ("CENTRAL INDEX KEY", DIGITS), "standard_industrial_classification": ("STANDARD INDUSTRIAL CLASSIFICATION", LINE), "irs_number": ("IRS NUMBER", TOKEN), "fiscal_year_end": ("FISCAL YEAR END", TOKEN)}
VALUES = {"form_type": ("FORM TYPE", TOKEN), "act": ("ACT", LINE), "file_number": ("FILE NUMBER", TOKEN), "film_number": ("FILM NUMBER", TOKEN)}
DATES = ("conformed_period_of_report", "filed_as_of_date", "date_as_of_change", "effectiveness_date")


def first_group(text: Column, pattern: str, flags: str = "dU") -> Column:
    """Group 1 of the first match, NULL if none (a match of nothing counts as none)."""
    return F.nullif(F.regexp_extract(text, f"(?{flags}){pattern}", 1), F.lit(""))


def field(text: Column, label: str, shape: str) -> Column:
    return F.regexp_replace(first_group(text, f"{label}:{shape}", "dmU"), r"(?U)^\s+|\s+$", "")


def punctuated(value: Column) -> Column:
    """Eight digits as YYYY-MM-DD, unchecked; anything else as it is."""
    dashed = F.concat_ws("-", F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2))
    return F.when(value.rlike(r"^\d{8}$"), dashed).otherwise(value)


def header_fields(text: Column) -> dict[str, Column]:
    """HDR-1..3: flat fields, filer struct, form_type and cik lifted."""
    head = F.substring(text, 1, HEADER_CHARS)
    out = {name: field(head, *how) for name, how in FLAT.items()}
    out |= {name: punctuated(out[name]) for name in DATES}
    company = {name: field(head, *how) for name, how in COMPANY.items()}
    values = {name: field(head, *how) for name, how in VALUES.items()}
    struct = lambda d: F.struct(*[c.alias(n) for n, c in d.items()])
    return out | {"form_type": values["form_type"], "cik": company["central_index_key"], "filer": F.struct(struct(company).alias("company_data"), struct(values).alias("filing_values"))}


def filing_date(text: Column) -> Column:
    """HDR-4: the first pattern that matches is final, so an impossible date is NULL."""
    head = F.substring(text, 1, WINDOW_CHARS)
    found = F.coalesce(first_group(head, r"FILED AS OF DATE:\s*(\d{8})"), first_group(head, r"<SEC-HEADER>[^:]+:\s*(\d{8})"), first_group(head, r"FILING[- ]DATE:\s*(\d{8})", "dUi"))
    return F.try_to_date(found, "yyyyMMdd") if hasattr(F, "try_to_date") else F.to_date(F.try_to_timestamp(found, F.lit("yyyyMMdd")))


def scanned_date(text: Column) -> Column:
    """HDR-4b: the first line of the whole text that carries either kind of date decides."""
    line = r"(?:[^\n]*?FILED AS OF DATE:[^\S\n]*(\d{8})|[^\n]*<SEC-HEADER>[^\n]*:[^\S\n]*(\d{8})[^\S\n]*(?=\n|\z))"
    whole = F.regexp_extract(text, f"(?dU)(?:^|\n){line}", 0)
    return F.to_date(F.try_to_timestamp(first_group(whole, r"(\d{8})[^\d]*\z"), F.lit("yyyyMMdd")))


def accession(text: Column, file_path: Column) -> Column:
    """HDR-5: header, then SEC-HEADER tag, then file name."""
    head = F.substring(text, 1, WINDOW_CHARS)
    base = F.element_at(F.split(file_path, "/"), -1)
    return F.coalesce(first_group(head, r"ACCESSION[ -]NUMBER:\s*(\d+-\d+-\d+)", "dUi"), first_group(head, r"<SEC-HEADER>(\d+-\d+-\d+)"), first_group(base, r"(\d+-\d+-\d+)"))


def blocks(text: Column) -> Column:
    """DOC-1: the <DOCUMENT> blocks, or the whole text as one."""
    found = F.regexp_extract_all(text, F.lit("(?s)<DOCUMENT>(.*?)</DOCUMENT>"), 1)
    return F.when(F.size(found) == 0, F.array(text)).otherwise(found)


def type_tag(block: Column) -> Column:
    """DOC-2: a missing tag is UNKNOWN, an empty one stays empty."""
    pattern = r"(?dU)<TYPE>(.*?)\n"
    return F.when(block.rlike(pattern), F.regexp_replace(F.regexp_extract(block, pattern, 1), r"(?U)^\s+|\s+$", "")).otherwise(F.lit("UNKNOWN"))


def text_content(block: Column) -> Column:
    pattern = r"(?ds)<TEXT>(.*?)(?:</TEXT>|$)"
    return F.when(block.rlike(pattern), F.regexp_extract(block, pattern, 1)).otherwise(block)


def block_cik(block: Column) -> Column:
    return F.coalesce(*[first_group(block, p) for p in (r"<CIK>(\d+)</CIK>", r"CENTRAL INDEX KEY:\s+(\d+)", r"CIK=(\d+)", r"CIK: (\d+)")])


def path_part(file_path: Column, back: int) -> Column:
    """A directory of the path, counted from the file (1: the one that holds it)."""
    return F.get(F.reverse(F.split(file_path, "/")), F.lit(back))


def ticker(file_path: Column, explicit: str | None = None, default: str = "UNKNOWN", mapped: Column | None = None) -> Column:
    """TKR-1: explicit, mapped, configured, else the grandparent directory unless empty or dotted."""
    if explicit:
        return F.lit(explicit)
    above = path_part(file_path, 2)
    inferred = F.when((F.coalesce(above, F.lit("")) != "") & ~above.startswith("."), above).otherwise(F.lit(default)) if default == "UNKNOWN" else F.lit(default)
    return F.coalesce(mapped, inferred) if mapped is not None else inferred


def kept_block(type_tag: Column, forms: tuple[str, ...], process_all: bool) -> Column:
    """FLT-1, to stand before any extraction."""
    return F.lit(True) if process_all else type_tag.isin(*forms, "UNKNOWN")
