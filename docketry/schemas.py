"""Table schemas."""

from __future__ import annotations

CATALOG = "id bigint, ticker string, filing_type string, filing_date date, file_path string, accession_number string, download_date date, parsed boolean, parse_date date, parse_status string"
FILINGS_LOG = "id bigint, ticker string, filing_type string, filing_date date, file_path string, accession_number string, download_date date, op_ts timestamp"
STATUS_LOG = "id bigint, parsed boolean, parse_date date, parse_status string, op_ts timestamp"
TABLE = "struct<table_name:string,match_tier:string,rows:array<array<string>>>"
SECTION = "struct<title:string,level:int,parent_title:string,content:string>"
EXTRACT = f"struct<html_tables:array<{TABLE}>,text_tables:array<{TABLE}>,sections:array<{SECTION}>,error:string>"
