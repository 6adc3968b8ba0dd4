"""The SQL counterpart of each registered query, written independently of the operators."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# The provider-shaped view over the given tables.
SOURCE = """provider_src AS (
  SELECT
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS ProviderID,
    split_part(c_name, '#', 1) AS FirstName,
    CASE WHEN o_orderkey % 3 = 0 THEN substr(c_mktsegment, 1, 1) END AS MiddleName,
    split_part(c_name, '#', 2) AS LastName,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE c_name END AS FullName,
    o_orderpriority AS Credential,
    CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS Gender,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 'I' ELSE 'A' END AS Status,
    CAST(CAST(o_orderdate AS DATE) AS STRING) AS LastUpdated,
    CASE WHEN o_orderkey % 83 = 0 THEN NULL
         ELSE concat(CAST(o_custkey % 400 AS STRING), ' ', n_name, ' ST') END AS AddressLine1,
    n_name AS City,
    r_name AS State,
    CAST(10000 + c_nationkey * 7 AS STRING) AS PostalCode,
    CASE WHEN o_orderkey % 53 = 0 THEN 'CA' ELSE 'US' END AS CountryCode,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL
         ELSE concat('410-', CAST(1000 + o_orderkey % 2000 AS STRING)) END AS PhoneNumber,
    CASE WHEN o_orderkey % 61 = 0 THEN NULL
         ELSE concat('TX', CAST(o_custkey % 22 AS STRING)) END AS TaxonomyCode,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('LIC', CAST(o_orderkey AS STRING)) END AS LicenseNumber,
    CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE concat('ID', CAST(o_orderkey AS STRING)) END AS Identifier,
    'NPPES' AS SOURCE_SYSTEM, 'JISB' AS PAYLOAD_FORMAT, 'MDM' AS TARGET_SYSTEM,
    o_orderdate AS LOAD_TIMESTAMP,
    CAST(o_orderdate AS DATE) AS LOAD_DATE,
    concat('processed_', CAST(year(o_orderdate) AS STRING), '.json') AS FILE_NAME,
    concat('BATCH_', CAST(year(o_orderdate) AS STRING)) AS BATCH_ID,
    o_orderkey AS SRC_KEY
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

RULE_STATUS = """CASE WHEN ProviderID IS NULL THEN 'FAIL'
  WHEN Status IS DISTINCT FROM 'A' THEN 'FAIL'
  WHEN TaxonomyCode IS NULL THEN 'FAIL'
  WHEN CountryCode IS DISTINCT FROM 'US' THEN 'FAIL'
  ELSE 'PASS' END"""
RULE_STATUS_COMPAT = RULE_STATUS.replace("IS DISTINCT FROM", "<>")
RULE_MESSAGE = """CASE WHEN ProviderID IS NULL THEN 'ProviderID is missing'
  WHEN Status IS DISTINCT FROM 'A' THEN 'Inactive Provider'
  WHEN TaxonomyCode IS NULL THEN 'TaxonomyCode is missing'
  WHEN CountryCode IS DISTINCT FROM 'US' THEN 'Invalid Country'
  ELSE 'Business rules passed' END"""
WARNING = """CASE WHEN PhoneNumber IS NULL THEN 'PhoneNumber Missing'
  WHEN LicenseNumber IS NULL THEN 'LicenseNumber Missing'
  WHEN Identifier IS NULL THEN 'Identifier Missing'
  ELSE 'No Data Quality Issues' END"""
FULL_NAME = "coalesce(nullif(FullName, ''), concat_ws(' ', FirstName, MiddleName, LastName))"
STATUS_ORDER = "CASE WHEN Status = 'A' THEN 1 ELSE 0 END DESC"
STATUS_ORDER_COMPAT = "Status DESC NULLS LAST"

PUBLISHED = [
    "ProviderID", "FullName", "Credential", "Gender", "Status", "AddressLine1", "City", "State",
    "PostalCode", "CountryCode", "PhoneNumber", "TaxonomyCode", "LicenseNumber", "Identifier",
]
AUDIT = [
    "SOURCE_SYSTEM", "PAYLOAD_FORMAT", "TARGET_SYSTEM", "LOAD_TIMESTAMP", "LOAD_DATE",
    "FILE_NAME", "BATCH_ID",
]
FLAGS = ["BUSINESS_RULE_STATUS", "DATA_QUALITY_WARNING"]
GOLD = PUBLISHED + FLAGS + AUDIT
VIEWED = [
    "ProviderID", "FirstName", "MiddleName", "LastName", "FullName", "Credential", "Gender",
    "Status", "LastUpdated", "AddressLine1", "City", "State", "PostalCode", "CountryCode",
    "PhoneNumber", "TaxonomyCode", "LicenseNumber", "Identifier",
]
ABSENT = [
    "EnumerationDate", "CountryName", "FaxNumber", "TaxonomyDescription", "LicenseState",
    "IdentifierIssuer", "IdentifierType",
]


def cte(name: str, body: str) -> str:
    return f"{name} AS ({body})"


def place(compat: bool = False) -> str:
    status = STATUS_ORDER_COMPAT if compat else STATUS_ORDER
    return (
        f"row_number() OVER (PARTITION BY ProviderID ORDER BY {status}, "
        "CAST(LastUpdated AS DATE) DESC NULLS LAST, SRC_KEY DESC)"
    )


def golden_cte(name: str = "gold", where: str = "true", compat: bool = False) -> str:
    plain = [f"{FULL_NAME} AS FullName" if c == "FullName" else c for c in PUBLISHED]
    rule = RULE_STATUS_COMPAT if compat else RULE_STATUS
    return cte(name, f"""
      SELECT {', '.join(plain)}, {rule} AS BUSINESS_RULE_STATUS,
             {WARNING} AS DATA_QUALITY_WARNING, {', '.join(AUDIT)}
      FROM (SELECT *, {place(compat)} AS place FROM provider_src WHERE {where}) ranked
      WHERE place = 1""")


def on_source(name: str, sql: str) -> None:
    ORACLES[name] = f"WITH {SOURCE} {sql}"


def on_gold(name: str, sql: str, compat: bool = False) -> None:
    ORACLES[name] = f"WITH {SOURCE}, {golden_cte(compat=compat)} {sql}"


LANDING = cte("landing", f"""
  SELECT {', '.join(PUBLISHED)}, {RULE_STATUS} AS BUSINESS_RULE_STATUS,
         {WARNING} AS DATA_QUALITY_WARNING, {', '.join(AUDIT)} FROM provider_src""")


def on_landing(name: str, sql: str) -> None:
    ORACLES[name] = f"WITH {SOURCE}, {LANDING} {sql}"


ALL = ", ".join(GOLD)
DONE = "('BATCH_1995', 'BATCH_1996', 'BATCH_1997', 'BATCH_1998')"

# A. Sources, sinks, tables

on_source("raw_provider_explode", """, providers AS (
    SELECT *, ProviderID AS number FROM provider_src WHERE SRC_KEY % 10 <> 9
    UNION ALL
    SELECT *, ProviderID || 'T' FROM provider_src WHERE SRC_KEY % 10 <> 9 AND SRC_KEY % 3 = 0)
  SELECT number AS PROVIDER_ID, LastName AS LAST_NAME, CAST(2 AS BIGINT) AS N_ADDRESSES,
         CAST(CASE WHEN TaxonomyCode IS NULL THEN 0 ELSE 2 END AS BIGINT) AS N_TAXONOMIES,
         CAST(CASE WHEN Identifier IS NULL THEN 0 ELSE 1 END AS BIGINT) AS N_IDENTIFIERS
  FROM providers""")
on_source("raw_archive", """
  SELECT CASE WHEN SRC_KEY % 10 <> 9 THEN ProviderID END AS PROVIDER_ID,
         CAST(CASE WHEN SRC_KEY % 10 = 9 THEN NULL WHEN SRC_KEY % 3 = 0 THEN 2 ELSE 1 END AS BIGINT)
           AS RESULT_COUNT
  FROM provider_src""")
ENVELOPES = f"""
  SELECT 'US' AS CODE_BASE, CAST(25 AS BIGINT) AS N_FIELDS, coalesce(ProviderID, '') AS PROVIDER_ID,
         {', '.join(AUDIT)} FROM provider_src"""
for _name in ("envelope_build", "bronze_ingest", "payload_parse"):
    on_source(_name, ENVELOPES)
_TYPES = {"LOAD_TIMESTAMP": "timestamp_ntz", "LOAD_DATE": "date"}
on_gold("schema_contract", " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS POSITION, '{c}' AS COLUMN_NAME, "
    f"'{_TYPES.get(c, 'string')}' AS DATA_TYPE, count({c}) AS N_VALUES FROM gold"
    for i, c in enumerate(GOLD)
))
on_gold("export_batch_slice", f"SELECT {ALL} FROM gold WHERE BATCH_ID = 'BATCH_1999'")
on_gold("export_log_rows", """
  SELECT BATCH_ID, count(*) AS ROW_COUNT, 'SUCCESS' AS STATUS, CAST(NULL AS VARCHAR) AS ERROR_MESSAGE
  FROM gold GROUP BY BATCH_ID""")
on_gold("load_by_name", f"""
  SELECT {', '.join("CAST(NULL AS VARCHAR) AS Identifier" if c == "Identifier" else c for c in GOLD)}
  FROM gold WHERE PostalCode <> '10070'""")
on_gold("load_by_name_rejects", """
  SELECT 'LOAD_DATE' AS FAILED_COLUMNS, ProviderID AS PROVIDER_ID, 'not a date' AS LOAD_DATE_TEXT
  FROM gold WHERE PostalCode = '10070'""")
on_gold("load_by_name_bad_files", """
  SELECT BATCH_ID, count(*) AS ROWS FROM gold WHERE BATCH_ID <> 'BATCH_1997' GROUP BY BATCH_ID
  UNION ALL SELECT 'corrupt.parquet', 1""")
on_gold("late_old_file", """
  SELECT BATCH_ID, count(*) AS ROWS FROM gold GROUP BY BATCH_ID
  UNION ALL SELECT 'new.parquet', 1""")
ORACLES["load_replay_split"] = f"""WITH {SOURCE}, {golden_cte()}, {golden_cte('late', "BATCH_ID = 'BATCH_1997'")}
  SELECT BATCH_ID, count(*) AS ROWS FROM gold WHERE BATCH_ID <> 'BATCH_1997' GROUP BY BATCH_ID
  UNION ALL SELECT 'BATCH_1997', count(*) FROM late"""
on_landing("initial_load", f"SELECT {ALL} FROM landing")
on_gold("backfill", f"SELECT {ALL} FROM gold")
on_gold("load_history", """
  SELECT BATCH_ID, CASE WHEN BATCH_ID <> 'BATCH_2001' THEN count(*) END AS ROWS_LOADED
  FROM gold GROUP BY BATCH_ID""")

# B. Standardise and build payloads

on_source("primary_element", """
  SELECT SRC_KEY,
    CASE WHEN SRC_KEY % 4 = 0 THEN 'ELSEWHERE' ELSE City END AS FIRST_CITY,
    City AS LOCATION_CITY,
    TaxonomyCode AS FIRST_TAXONOMY,
    CASE WHEN TaxonomyCode IS NULL THEN NULL WHEN SRC_KEY % 5 = 0 THEN TaxonomyCode ELSE 'TX99' END
      AS PRIMARY_TAXONOMY,
    Identifier AS FIRST_IDENTIFIER
  FROM provider_src""")
_MAILED = "SRC_KEY % 4 = 0"


def _flat(c: str) -> str:
    swapped = {
        "AddressLine1": "'PO BOX 1'", "City": "'ELSEWHERE'", "PostalCode": "'00000'",
        "PhoneNumber": "''",
    }
    special = {
        "FullName": "concat_ws(' ', FirstName, MiddleName, LastName)",
        "EnumerationDate": "''",
        "CountryName": "'United States'",
        "FaxNumber": f"CASE WHEN {_MAILED} THEN '410-0000' ELSE '' END",
        "TaxonomyDescription": "CASE WHEN TaxonomyCode IS NULL THEN '' ELSE 'Specialty' END",
        "LicenseNumber": "CASE WHEN TaxonomyCode IS NULL THEN '' ELSE coalesce(LicenseNumber, '') END",
        "LicenseState": "CASE WHEN TaxonomyCode IS NULL THEN '' ELSE State END",
        "IdentifierIssuer": "CASE WHEN Identifier IS NULL THEN '' ELSE 'STATE' END",
        "IdentifierType": "CASE WHEN Identifier IS NULL THEN '' ELSE 'MEDICAID' END",
    }
    if c in special:
        return f"{special[c]} AS {c}"
    value = f"coalesce({c}, '')"
    if c in swapped:
        value = f"CASE WHEN {_MAILED} THEN {swapped[c]} ELSE {value} END"
    return f"{value} AS {c}"


FLAT = ", ".join(_flat(c) for c in VIEWED + ABSENT)
on_source("flatten_provider", f"SELECT {FLAT} FROM provider_src")
on_source("full_name_join", """
  SELECT SRC_KEY, concat_ws(' ', CASE WHEN SRC_KEY % 5 <> 0 THEN FirstName END, MiddleName, LastName)
    AS FULL_NAME FROM provider_src""")
on_source("standardised_count", 'SELECT count(*) AS "totalRecords" FROM provider_src')
on_source("codbase_lookup", """
  SELECT SRC_KEY, CASE WHEN SRC_KEY % 11 = 0 THEN 'US'
    WHEN SRC_KEY % 7 = 0 THEN 'IN' WHEN SRC_KEY % 7 = 3 THEN 'CA' WHEN SRC_KEY % 7 = 4 THEN 'GB'
    ELSE 'US' END AS CODE_BASE FROM provider_src""")
_ORDERED = [
    "ProviderID", "FirstName", "MiddleName", "LastName", "FullName", "Credential", "Gender",
    "Status", "EnumerationDate", "LastUpdated", "AddressLine1", "City", "State", "PostalCode",
    "CountryCode", "CountryName", "PhoneNumber", "FaxNumber", "TaxonomyCode",
    "TaxonomyDescription", "LicenseNumber", "LicenseState", "Identifier", "IdentifierIssuer",
    "IdentifierType",
]
_PRECISION = {"FullName": 95, "AddressLine1": 90, "City": 90, "TaxonomyDescription": 90}
on_source("payload_build", f"""
  SELECT CAST(year(LOAD_DATE) AS VARCHAR) AS LOAD_YEAR, '20' AS RESULT_SIZE,
    'Activity' AS ENTITY_TYPE, 'US' AS CODE_BASES,
    '{",".join(_ORDERED)}' AS NAMES,
    '{",".join("FUZZY" if c in _PRECISION else "EXACT" for c in _ORDERED)}' AS METHODS,
    '{",".join(str(_PRECISION.get(c, 100)) for c in _ORDERED)}' AS PRECISIONS,
    {" || '|' || ".join("''" if c in ABSENT else f"coalesce({c}, '')" for c in _ORDERED)} AS FIELD_VALUES
  FROM provider_src""")
on_source("payload_roundtrip", f"""
  , flat AS (SELECT {FLAT}, {', '.join(AUDIT)} FROM provider_src)
  SELECT DISTINCT {', '.join(f"nullif({c}, '') AS {c}" for c in _ORDERED)}, {', '.join(AUDIT)}
  FROM flat""")
on_source("batch_identity", """
  SELECT DISTINCT LOAD_TIMESTAMP,
    'BATCH_' || strftime(LOAD_TIMESTAMP, '%Y%m%d_%H%M%S') AS BATCH_ID,
    'raw_' || strftime(LOAD_TIMESTAMP, '%Y%m%d_%H%M%S') || '.json' AS RAW_FILE,
    'processed_' || strftime(LOAD_TIMESTAMP, '%Y%m%d_%H%M%S') || '.json' AS FILE_NAME
  FROM provider_src""")

# C. Silver

on_source("new_batch_anti", f"SELECT SRC_KEY, BATCH_ID FROM provider_src WHERE BATCH_ID NOT IN {DONE}")
ORACLES["json_parse"] = """
  SELECT event_id, CASE WHEN event_id % 10 <> 0
    THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END AS k FROM events"""
_FIELD_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS FIELD_NAME, {chr(39) * 2 if c in ABSENT else f'coalesce({c}, {chr(39) * 2})'} AS FIELD_VALUE, "
    f"'{'FUZZY' if c in _PRECISION else 'EXACT'}' AS MATCH_METHOD, "
    f"CAST({_PRECISION.get(c, 100)} AS INTEGER) AS FUZZY_PRECISION, FILE_NAME, BATCH_ID FROM provider_src"
    for c in _ORDERED
)
on_source("payload_flatten", _FIELD_ROWS)
on_source("payload_explode", f"""
  SELECT BATCH_ID, FIELD_NAME, count(*) AS N_ROWS FROM ({_FIELD_ROWS}) f
  GROUP BY BATCH_ID, FIELD_NAME""")
_PIVOT = f"""SELECT DISTINCT
  {', '.join(f"{chr(39) * 2} AS {c}" if c in ABSENT else f"coalesce({c}, '') AS {c}" for c in _ORDERED)},
  {', '.join(AUDIT)} FROM provider_src"""
on_source("payload_pivot", _PIVOT)
on_source("payload_pivot_noshuffle", _PIVOT)
on_source("clean_strings", """
  SELECT SRC_KEY, FirstName, CASE WHEN SRC_KEY % 3 <> 0 THEN City END AS City, PhoneNumber, LOAD_DATE
  FROM provider_src""")
on_source("null_report", "SELECT " + ", ".join(
    "CAST(100 AS DOUBLE) AS " + f"{c}_null_pct" if c in ABSENT else
    f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100, 6) AS {c}_null_pct"
    for c in _ORDERED + AUDIT
) + " FROM provider_src")
ORACLES["null_report_footers"] = ORACLES["null_report"]
ORACLES["layer_counts_footers"] = f"""WITH {SOURCE}, {golden_cte()}
  SELECT 'bronze' AS LAYER, count(*) AS TOTAL_RECORDS FROM provider_src UNION ALL SELECT 'silver', count(*) FROM provider_src
  UNION ALL SELECT 'gold', count(*) FROM gold"""
on_source("batch_presence", """
  SELECT b AS BATCH_ID, CAST(0 AS BIGINT) AS ROWS_BEFORE,
    (SELECT count(*) FROM provider_src WHERE BATCH_ID = b) AS ROWS_AFTER
  FROM (VALUES ('BATCH_1996'), ('BATCH_1900')) asked(b)""")
on_source("batch_list", "SELECT DISTINCT BATCH_ID FROM provider_src")

# D. Gold

on_source("br_status", f"SELECT SRC_KEY, {RULE_STATUS} AS BUSINESS_RULE_STATUS FROM provider_src")
on_source("br_status_compat",
          f"SELECT SRC_KEY, {RULE_STATUS_COMPAT} AS BUSINESS_RULE_STATUS FROM provider_src")
on_source("br_message", f"SELECT SRC_KEY, {RULE_MESSAGE} AS BUSINESS_RULE_MESSAGE FROM provider_src")
on_source("br_message_compat",
          f"SELECT SRC_KEY, {RULE_MESSAGE.replace('IS DISTINCT FROM', '<>')} AS BUSINESS_RULE_MESSAGE "
          "FROM provider_src")
on_source("fullname_fill", f"SELECT SRC_KEY, {FULL_NAME} AS FullName FROM provider_src")
on_source("dq_warning", f"SELECT SRC_KEY, {WARNING} AS DATA_QUALITY_WARNING FROM provider_src")
_SIZED = "count(*) OVER (PARTITION BY ProviderID)"
on_source("exact_match", f"""
  SELECT SRC_KEY, {_SIZED} AS EXACT_MATCH_COUNT,
    CASE WHEN {_SIZED} > 1 THEN 'MATCH' ELSE 'UNIQUE' END AS EXACT_MATCH_STATUS FROM provider_src""")
on_source("duplicate_flag", f"""
  SELECT SRC_KEY, {_SIZED} AS DUPLICATE_COUNT,
    CASE WHEN {_SIZED} > 1 THEN 'DUPLICATE' ELSE 'UNIQUE' END AS DUPLICATE_STATUS FROM provider_src""")
_FUZZY = """, keyed AS (SELECT *, {key} AS FUZZY_MATCH_KEY FROM provider_src),
  sized AS (SELECT *, CASE WHEN FUZZY_MATCH_KEY IS NULL THEN 1
    ELSE count(*) OVER (PARTITION BY FUZZY_MATCH_KEY) END AS FUZZY_MATCH_COUNT FROM keyed),
  fuzzy AS (SELECT *, CASE WHEN FUZZY_MATCH_COUNT > 1 THEN 'REVIEW' ELSE 'UNIQUE' END
    AS FUZZY_MATCH_STATUS FROM sized)
  """
_STRICT = _FUZZY.format(key="PhoneNumber || '|' || PostalCode")
_LOOSE = _FUZZY.format(key="concat_ws('|', PhoneNumber, PostalCode)")
_FUZZY_COLUMNS = "SRC_KEY, FUZZY_MATCH_KEY, FUZZY_MATCH_COUNT, FUZZY_MATCH_STATUS"
on_source("fuzzy_match", f"{_STRICT} SELECT {_FUZZY_COLUMNS} FROM fuzzy")
on_source("fuzzy_match_compat", f"{_LOOSE} SELECT {_FUZZY_COLUMNS} FROM fuzzy")
for _compat in (False, True):
    on_source("survivor_rank_compat" if _compat else "survivor_rank", f"""
      SELECT SRC_KEY, ProviderID, Status, {place(_compat)} AS SURVIVOR_RANK,
        CASE WHEN {place(_compat)} = 1 THEN 'SURVIVOR' ELSE 'DISCARDED' END AS SURVIVOR_STATUS
      FROM provider_src""")
    on_gold("golden_record_compat" if _compat else "golden_record", f"SELECT {ALL} FROM gold", _compat)
on_gold("gate_batch", f"SELECT {ALL} FROM gold WHERE BATCH_ID NOT IN {DONE}")
_DAY = "'BATCH_' || strftime(LOAD_TIMESTAMP, '%Y%m%d_%H%M%S') AS BATCH_ID"
_GATE = f"""WITH {SOURCE},
  {golden_cte('everyone')},
  held AS (SELECT * FROM everyone WHERE CAST(ProviderID AS INTEGER) % 5 = 0),
  {golden_cte('yearly')},
  fresh AS (SELECT {', '.join(c for c in GOLD if c != 'BATCH_ID')}, {_DAY} FROM yearly),
  verdict AS (
    SELECT f.BATCH_ID, count(DISTINCT f.ProviderID) AS PROVIDERS,
      count(DISTINCT h.ProviderID) AS KNOWN_PROVIDERS, count(h.ProviderID) > 0 AS BLOCKED
    FROM fresh f LEFT JOIN held h ON f.ProviderID = h.ProviderID GROUP BY f.BATCH_ID)
  """
ORACLES["gate_provider"] = f"""{_GATE} SELECT {ALL} FROM fresh
  WHERE BATCH_ID NOT IN (SELECT BATCH_ID FROM verdict WHERE BLOCKED)"""
ORACLES["gate_provider_verdicts"] = f"{_GATE} SELECT * FROM verdict"
ORACLES["gate_provider_anti"] = f"""{_GATE} SELECT {ALL} FROM fresh
  WHERE NOT EXISTS (SELECT 1 FROM held WHERE held.ProviderID = fresh.ProviderID)"""
ORACLES["gate_provider_upsert"] = f"""{_GATE} SELECT {ALL} FROM fresh UNION ALL
  SELECT {ALL} FROM held WHERE NOT EXISTS (SELECT 1 FROM fresh WHERE fresh.ProviderID = held.ProviderID)"""
_BACK = "BATCH_ID < 'BATCH_1997' AND coalesce(CAST(ProviderID AS INTEGER) % 50 = 0, false)"
ORACLES["gate_poison"] = f"""WITH {SOURCE},
  fresh AS (SELECT * REPLACE (CASE WHEN BATCH_ID = 'BATCH_1997' OR CAST(ProviderID AS INTEGER) % 50 <> 0 THEN ProviderID
      ELSE ProviderID || 'X' END AS ProviderID) FROM provider_src WHERE NOT ({_BACK})),
  blocked AS (SELECT DISTINCT BATCH_ID FROM fresh WHERE ProviderID IN (SELECT ProviderID FROM provider_src WHERE {_BACK})),
  {golden_cte('gold', "BATCH_ID NOT IN (SELECT BATCH_ID FROM blocked)").replace("FROM provider_src", "FROM fresh")}
  SELECT {ALL} FROM gold"""
on_source("late_file_batch", """
  SELECT BATCH_ID, count(*) AS ROWS, count(ProviderID) AS IDS FROM provider_src GROUP BY BATCH_ID""")
on_gold("gate_export", f"""SELECT {ALL} FROM gold
  WHERE BATCH_ID NOT IN ('BATCH_1995', 'BATCH_1996', 'BATCH_1997')""")
on_gold("batch_consistency", """
  SELECT b AS BATCH_ID, CASE WHEN n > 0 THEN (SELECT count(*) FROM gold) END AS TOTAL_RECORDS,
    n > 0 AS CONSISTENT
  FROM (SELECT b, (SELECT count(*) FROM gold WHERE BATCH_ID = b) AS n
        FROM (VALUES ('BATCH_1999'), ('BATCH_1900')) asked(b)) counted""")
on_source("review_match", f"""
  SELECT ProviderID, FirstName, FullName, EXACT_MATCH_COUNT, 'MATCH' AS EXACT_MATCH_STATUS
  FROM (SELECT *, {_SIZED} AS EXACT_MATCH_COUNT FROM provider_src) s WHERE EXACT_MATCH_COUNT > 1
  ORDER BY ProviderID NULLS LAST, SRC_KEY LIMIT 20""")
on_source("review_fuzzy", f"""{_STRICT}
  SELECT ProviderID, FirstName, FullName, PhoneNumber, PostalCode, FUZZY_MATCH_KEY,
    FUZZY_MATCH_COUNT, FUZZY_MATCH_STATUS
  FROM fuzzy WHERE FUZZY_MATCH_STATUS = 'REVIEW'
  ORDER BY FUZZY_MATCH_KEY NULLS LAST, SRC_KEY LIMIT 20""")
on_source("review_duplicate", f"""
  SELECT ProviderID, FirstName, LastUpdated, DUPLICATE_COUNT, 'DUPLICATE' AS DUPLICATE_STATUS
  FROM (SELECT *, {_SIZED} AS DUPLICATE_COUNT FROM provider_src) s WHERE DUPLICATE_COUNT > 1
  ORDER BY ProviderID NULLS LAST, SRC_KEY LIMIT 20""")
on_source("review_rules", f"""
  SELECT ProviderID, Status, CountryCode, {RULE_STATUS} AS BUSINESS_RULE_STATUS,
    {RULE_MESSAGE} AS BUSINESS_RULE_MESSAGE FROM provider_src ORDER BY SRC_KEY LIMIT 20""")
on_source("review_quality", f"""
  SELECT ProviderID, FirstName, MiddleName, LastName, {FULL_NAME} AS FullName, PhoneNumber,
    LicenseNumber, Identifier, {WARNING} AS DATA_QUALITY_WARNING
  FROM provider_src ORDER BY SRC_KEY LIMIT 20""")
on_source("review_survivors", f"""
  SELECT ProviderID, FirstName, Status, LastUpdated, SURVIVOR_RANK,
    CASE WHEN SURVIVOR_RANK = 1 THEN 'SURVIVOR' ELSE 'DISCARDED' END AS SURVIVOR_STATUS
  FROM (SELECT *, {_SIZED} AS n, {place()} AS SURVIVOR_RANK FROM provider_src) s WHERE n > 1
  ORDER BY ProviderID NULLS LAST, SURVIVOR_RANK LIMIT 20""")

# Configured fields

_PASSES = "levenshtein(a.v, b.v) <= CAST(floor(greatest(length(a.v), length(b.v)) * (100 - {p}) / 100.0) AS BIGINT)"
_SIMILAR = """SELECT '{f}' AS FIELD, a.State, a.v AS VALUE_A, b.v AS VALUE_B, a.n AS RECORDS_A, b.n AS RECORDS_B,
    round(100 * (greatest(length(a.v), length(b.v)) - levenshtein(a.v, b.v)) / greatest(length(a.v), length(b.v)), 6) AS SIMILARITY
  FROM class_{f} a JOIN class_{f} b ON a.State = b.State AND (length(a.v) < length(b.v) OR length(a.v) = length(b.v) AND a.v < b.v)
  WHERE """ + _PASSES


def _classes(field: str) -> str:
    return f"class_{field} AS (SELECT State, {field} AS v, count(*) AS n FROM provider_src WHERE {field} IS NOT NULL AND State IS NOT NULL GROUP BY ALL)"


_FUZZY = {"FullName": 95, "AddressLine1": 90, "City": 90}
ORACLES["field_match_score"] = f"WITH {SOURCE}, " + ", ".join(map(_classes, _FUZZY)) + " " + " UNION ALL ".join(
    _SIMILAR.format(f=f, p=p) for f, p in _FUZZY.items())
ORACLES["field_match_members"] = f"""WITH {SOURCE}, {_classes("AddressLine1")},
  near AS (SELECT a.State, a.v, CAST(sum(b.n) AS BIGINT) AS n FROM class_AddressLine1 a
    JOIN class_AddressLine1 b ON a.State = b.State AND a.v <> b.v AND {_PASSES.format(p=90)} GROUP BY ALL)
  SELECT SRC_KEY, s.State, AddressLine1 AS VALUE, coalesce(c.n - 1, 0) AS EQUAL_RECORDS, coalesce(near.n, 0) AS SIMILAR_RECORDS
  FROM provider_src s LEFT JOIN class_AddressLine1 c ON s.State = c.State AND AddressLine1 = c.v
  LEFT JOIN near ON s.State = near.State AND AddressLine1 = near.v"""
_HELD = ["ProviderID", "FirstName", "MiddleName", "LastName", "FullName", "Credential", "Gender", "Status", "LastUpdated", "AddressLine1",
         "City", "State", "PostalCode", "CountryCode", "PhoneNumber", "TaxonomyCode", "LicenseNumber", "Identifier"]


def _verdict(c: str) -> str:
    a, b = f"a.{c}", f"b.{c}"
    same = f"{a} = {b}"
    if c in _FUZZY:
        longer = f"greatest(length({a}), length({b}))"
        same = f"({longer} = 0 OR round(100 * ({longer} - levenshtein({a}, {b})) / {longer}, 6) >= {_FUZZY[c]})"
    return f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN 'MISSING' WHEN {same} THEN 'PASSED' ELSE 'FAILED' END"


_LISTED = {k: "concat_ws(',', " + ", ".join(f"CASE WHEN {_verdict(c)} = '{k}' THEN '{c}' END" for c in _HELD) + f") AS {k}" for k in ("PASSED", "FAILED", "MISSING")}
ORACLES["field_match_pairs"] = f"""WITH {SOURCE},
  keyed AS (SELECT *, lead(SRC_KEY) OVER (PARTITION BY PhoneNumber, PostalCode ORDER BY SRC_KEY) AS next
    FROM provider_src WHERE PhoneNumber IS NOT NULL)
  SELECT a.SRC_KEY, {', '.join(_LISTED.values())} FROM keyed a JOIN provider_src b ON a.next = b.SRC_KEY"""

# E. Change capture and upsert

on_gold("cdc_pending", f"SELECT {ALL} FROM gold WHERE BATCH_ID NOT IN {DONE}")
on_gold("cdc_pending_counts", f"""
  SELECT BATCH_ID, count(*) AS PENDING_RECORDS FROM gold WHERE BATCH_ID NOT IN {DONE}
  GROUP BY BATCH_ID""")
on_gold("cdc_has_data", f"SELECT count(*) > 0 AS HAS_DATA FROM gold WHERE BATCH_ID NOT IN {DONE}")
_SIDES = f"""WITH {SOURCE}, {golden_cte('target', "BATCH_ID <= 'BATCH_1999'")},
  {golden_cte('incoming', "BATCH_ID > 'BATCH_1999'")}"""
_MERGED = f"""{_SIDES}
  SELECT {ALL} FROM incoming UNION ALL
  SELECT {ALL} FROM target
  WHERE NOT EXISTS (SELECT 1 FROM incoming WHERE incoming.ProviderID = target.ProviderID)"""
for _name in ("merge_upsert", "merge_replay", "cdc_run"):
    ORACLES[_name] = _MERGED
_MOVED = f"""{_SIDES},
  moved AS (SELECT * REPLACE (CASE WHEN CAST(ProviderID AS INT) % 3 = 0 THEN 'ASIA' ELSE State END AS State) FROM incoming),
  merged AS (SELECT {ALL} FROM moved UNION ALL SELECT {ALL} FROM target
    WHERE NOT EXISTS (SELECT 1 FROM moved WHERE moved.ProviderID = target.ProviderID))"""
ORACLES["merge_written"] = f"{_MOVED} SELECT {ALL} FROM merged"
ORACLES["mart_incremental"] = f"""{_MOVED}
  SELECT State, count(*) AS TOTAL_PROVIDERS, count(*) FILTER (Status = 'A') AS ACTIVE_PROVIDERS,
         count(*) FILTER (Status = 'I') AS INACTIVE_PROVIDERS, count(*) FILTER (Gender = 'M') AS MALE_PROVIDERS,
         count(*) FILTER (Gender = 'F') AS FEMALE_PROVIDERS, count(DISTINCT TaxonomyCode) AS TOTAL_SPECIALIZATIONS
  FROM merged GROUP BY State"""
ORACLES["cdc_gate"] = f"""{_SIDES}, merged AS ({_MERGED.removeprefix(_SIDES)})
  SELECT CAST(STEP AS BIGINT) AS STEP, STEP % 2 = 0 AS HAS_DATA, STEP % 2 = 0 AS RAN, (SELECT count(*) FROM merged) AS MERGED FROM range(4) r(STEP)"""
ORACLES["run_history_failed"] = f"""{_SIDES}
  SELECT 'SUCCEEDED' AS STATE, count(*) AS SOURCE_ROWS, false AS TOLD FROM target UNION ALL SELECT 'FAILED', 0, true"""
on_source("archive_digests", "SELECT true AS EQUAL, count(*) AS RESPONSES FROM provider_src")
ORACLES["cdc_stream"] = f"""{_SIDES}
  SELECT {ALL} FROM target UNION ALL SELECT {ALL} FROM incoming"""
ORACLES["run_history"] = f"""{_SIDES}
  SELECT 'SUCCEEDED' AS STATE, count(*) AS SOURCE_ROWS, true AS TIMED FROM target UNION ALL
  SELECT 'SUCCEEDED', count(*), true FROM incoming"""

# F. Analyst questions


def counted(name: str, by: str, measure: str = "TOTAL_PROVIDERS", order: str | None = None) -> None:
    order = order or f"{measure} DESC, {by}"
    on_gold(name, f"SELECT {by}, count(*) AS {measure} FROM gold GROUP BY {by} ORDER BY {order}")


on_gold("q01_total", "SELECT count(*) AS TOTAL_PROVIDERS FROM gold")
for _name, _by in {
    "q02_status": "Status", "q03_state": "State", "q04_country": "CountryCode",
    "q05_gender": "Gender", "q06_credential": "Credential", "q07_city": "City",
    "q11_source": "SOURCE_SYSTEM", "q12_format": "PAYLOAD_FORMAT", "q13_target": "TARGET_SYSTEM",
    "q21_taxonomy": "TaxonomyCode", "q22_postal": "PostalCode", "q23_license": "LicenseNumber",
}.items():
    counted(_name, _by)
for _name, _by in {
    "q08_rules": "BUSINESS_RULE_STATUS", "q09_dq": "DATA_QUALITY_WARNING",
    "q20_batch": "BATCH_ID", "q24_file": "FILE_NAME",
}.items():
    counted(_name, _by, "TOTAL_RECORDS")
counted("q25_load_date", "LOAD_DATE", "TOTAL_RECORDS", "LOAD_DATE DESC NULLS LAST")
counted("q33_state_rules", "State, BUSINESS_RULE_STATUS", "TOTAL_RECORDS", "State")
counted("q34_state_dq", "State, DATA_QUALITY_WARNING", "TOTAL_RECORDS", "State")
counted("q35_state_gender", "State, Gender", order="State, TOTAL_PROVIDERS DESC")
_BATCHES = "SELECT DISTINCT BATCH_ID, FILE_NAME, LOAD_DATE FROM {} ORDER BY LOAD_DATE DESC"
on_gold("q10_batches", _BATCHES.format("gold"))
on_gold("q14_recent", """SELECT ProviderID, FullName, State, LOAD_TIMESTAMP FROM gold
  ORDER BY LOAD_TIMESTAMP DESC, ProviderID""")
_REPEATED = "SELECT ProviderID, count(*) AS DUPLICATE_COUNT FROM {} GROUP BY ProviderID HAVING count(*) > 1"
on_gold("q15_dups", _REPEATED.format("gold"))
for _name, _column in {
    "q16_no_phone": "PhoneNumber", "q17_no_license": "LicenseNumber",
    "q18_no_taxonomy": "TaxonomyCode", "q27_no_address": "AddressLine1",
    "q28_no_identifier": "Identifier",
}.items():
    on_gold(_name, f"SELECT {ALL} FROM gold WHERE {_column} IS NULL")
on_gold("q19_listing", f"SELECT {ALL} FROM gold ORDER BY FullName NULLS LAST, ProviderID")
on_gold("q26_top5", f"SELECT {ALL} FROM gold ORDER BY LOAD_TIMESTAMP DESC, ProviderID NULLS LAST LIMIT 5")
for _name, _column in {
    "q29_states": "State", "q30_cities": "City", "q31_credentials": "Credential",
    "q32_taxonomies": "TaxonomyCode",
}.items():
    on_gold(_name, f"SELECT DISTINCT {_column} FROM gold ORDER BY {_column}")

# G. Monitoring

_LAYERS = {"bronze": "provider_src", "silver": "provider_src", "gold": "gold", "landing": "gold", "keyed table": "gold", "dimension": "gold",
           "state mart": "(SELECT DISTINCT State FROM gold)"}
ORACLES["layer_counts"] = f"WITH {SOURCE}, {golden_cte()} " + " UNION ALL ".join(
    f"SELECT '{layer}' AS LAYER, count(*) AS TOTAL_RECORDS FROM {rows}" for layer, rows in _LAYERS.items())
on_landing("latest_rows", f"SELECT {ALL} FROM landing ORDER BY LOAD_TIMESTAMP DESC")
on_gold("latest_dimension_rows", f"SELECT {ALL} FROM gold ORDER BY LOAD_TIMESTAMP DESC")
on_landing("latest_batches", _BATCHES.format("landing"))
on_landing("landing_distributions", " UNION ALL ".join(
    f"SELECT '{c}' AS ATTRIBUTE, {c} AS VALUE, count(*) AS TOTAL_RECORDS FROM landing GROUP BY {c}"
    for c in ("SOURCE_SYSTEM", "CountryCode", "State", *FLAGS)
))
on_landing("duplicate_check", _REPEATED.format("landing"))
on_landing("dq_issue_rows",
           f"SELECT {ALL} FROM landing WHERE DATA_QUALITY_WARNING <> 'No Data Quality Issues'")
on_landing("dq_issue_rows_compat", f"SELECT {ALL} FROM landing WHERE DATA_QUALITY_WARNING IS NOT NULL")
on_landing("failed_rule_rows", f"SELECT {ALL} FROM landing WHERE BUSINESS_RULE_STATUS <> 'PASS'")
on_gold("export_audit", """
  SELECT BATCH_ID, count(*) AS ROW_COUNT, 'SUCCESS' AS STATUS FROM gold
  WHERE BATCH_ID = 'BATCH_1999' GROUP BY BATCH_ID""")

on_gold("export_audit_all", """
  SELECT BATCH_ID, count(*) AS ROW_COUNT, 'SUCCESS' AS STATUS, CAST(NULL AS VARCHAR) AS ERROR_MESSAGE
  FROM gold GROUP BY BATCH_ID
  UNION ALL SELECT DISTINCT BATCH_ID, 0, 'FAILED', 'no space' FROM gold""")
on_gold("export_replay", f"SELECT {ALL} FROM gold")
on_gold("sample_rows", f"SELECT {ALL} FROM gold ORDER BY ProviderID NULLS LAST, BATCH_ID NULLS LAST LIMIT 10")
on_source("audit_columns", f"""SELECT {', '.join(AUDIT)} FROM provider_src
  ORDER BY LOAD_TIMESTAMP NULLS LAST, FILE_NAME NULLS LAST, BATCH_ID NULLS LAST LIMIT 50""")

# H. Models, tests, reconciliation

STATES = "count(DISTINCT State) AS TOTAL_STATES"
CITIES = "count(DISTINCT City) AS TOTAL_CITIES"
SPECIALTIES = "count(DISTINCT TaxonomyCode) AS TOTAL_SPECIALIZATIONS"
TOTAL = "count(*) AS TOTAL_PROVIDERS"


def tally(condition: str, name: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"


def grouped(name: str, by: str, *measures: str) -> None:
    on_gold(name, f"SELECT {by}, {TOTAL}, {', '.join(measures)} FROM gold GROUP BY {by}")


on_gold("dim_provider", f"SELECT {ALL} FROM gold")
for _name, (_a, _i, _m, _f) in {
    "mart_state": ("A", "I", "M", "F"),
    "mart_state_compat": ("Active", "Inactive", "Male", "Female"),
}.items():
    grouped(_name, "State",
            tally(f"Status = '{_a}'", "ACTIVE_PROVIDERS"), tally(f"Status = '{_i}'", "INACTIVE_PROVIDERS"),
            tally(f"Gender = '{_m}'", "MALE_PROVIDERS"), tally(f"Gender = '{_f}'", "FEMALE_PROVIDERS"),
            SPECIALTIES)
for _name, _condition in {
    "mart_summary": "DATA_QUALITY_WARNING <> 'No Data Quality Issues'",
    "mart_summary_compat": "DATA_QUALITY_WARNING = 'YES'",
}.items():
    grouped(_name, "LOAD_DATE", STATES, CITIES, SPECIALTIES,
            tally("BUSINESS_RULE_STATUS = 'PASS'", "BUSINESS_RULE_PASS"),
            tally("BUSINESS_RULE_STATUS = 'FAIL'", "BUSINESS_RULE_FAIL"),
            tally(_condition, "DATA_QUALITY_WARNINGS"))
grouped("mart_gender", "Gender", STATES, SPECIALTIES)
grouped("mart_taxonomy", "TaxonomyCode", STATES, CITIES)
grouped("mart_rules", "BUSINESS_RULE_STATUS", STATES, SPECIALTIES)
grouped("mart_dq", "DATA_QUALITY_WARNING", STATES, SPECIALTIES)
on_landing("test_unique", """SELECT ProviderID, count(*) AS n_records FROM landing
  WHERE ProviderID IS NOT NULL GROUP BY ProviderID HAVING count(*) > 1""")
on_gold("test_not_null", f"""SELECT {ALL} FROM gold WHERE ProviderID IS NULL UNION ALL
  SELECT {ALL} FROM gold WHERE TaxonomyCode IS NULL""")
on_gold("test_accepted_values", """SELECT CountryCode AS value_field, count(*) AS n_records FROM gold
  WHERE CountryCode NOT IN ('US') GROUP BY CountryCode""")
on_gold("reconcile_counts",
        "SELECT (SELECT count(*) FROM gold) AS GOLD_COUNT, (SELECT count(*) FROM gold) AS DIM_COUNT")
on_gold("dim_cardinality", f"SELECT {STATES}, {CITIES}, {SPECIALTIES} FROM gold")
on_gold("dim_rule_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS ATTRIBUTE, {c} AS VALUE, count(*) AS TOTAL_RECORDS FROM gold GROUP BY {c}"
    for c in FLAGS
))
on_gold("dim_distincts", " UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS ATTRIBUTE, {c} AS VALUE FROM gold"
    for c in ("State", "City", "Gender", "Status", "CountryCode", "TaxonomyCode")
))
_MART_ROWS = " UNION ALL ".join(
    f"SELECT '{m}' AS LAYER, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM gold) d) AS TOTAL_RECORDS"
    for m, c in {
        "mart_provider_state": "State", "mart_provider_summary": "LOAD_DATE",
        "mart_provider_gender": "Gender", "mart_provider_taxonomy": "TaxonomyCode",
        "mart_provider_business_rules": "BUSINESS_RULE_STATUS",
        "mart_provider_data_quality": "DATA_QUALITY_WARNING",
    }.items()
)
on_gold("mart_counts", _MART_ROWS)
on_gold("materialised_models", f"SELECT 'dim_provider' AS LAYER, count(*) AS TOTAL_RECORDS FROM gold UNION ALL {_MART_ROWS}")

# I. Dashboard figures

_PASSED = tally("BUSINESS_RULE_STATUS = 'PASS'", "BUSINESS_RULE_PASS")
_KPI = f"SELECT {TOTAL}, {STATES}, {CITIES}, {SPECIALTIES}"
_SLICE = "State IN ('ASIA', 'EUROPE') AND Gender = 'F'"
on_gold("kpi_row", f"{_KPI}, {_PASSED} FROM gold")
on_gold("kpi_row_compat", f"{_KPI}, count(*) AS BUSINESS_RULE_PASS FROM gold")
on_gold("kpi_sliced", f"{_KPI}, {_PASSED} FROM gold WHERE {_SLICE}")
on_gold("mart_sliced", f"""SELECT TaxonomyCode, {TOTAL}, {STATES}, {CITIES} FROM gold
  WHERE State = 'AFRICA' GROUP BY TaxonomyCode""")
ORACLES["cross_filter"] = ORACLES["mart_state"].replace(
    "FROM gold GROUP BY State", f"FROM gold WHERE State IN (SELECT State FROM gold WHERE {_SLICE}) GROUP BY State")
for _name, _by in {"share_by_gender": "Gender", "share_by_dq": "DATA_QUALITY_WARNING"}.items():
    on_gold(_name, f"""SELECT {_by}, {TOTAL},
      round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM gold), 6) AS PERCENT FROM gold GROUP BY {_by}""")
on_gold("top10_taxonomy", f"""SELECT TaxonomyCode, {TOTAL} FROM gold GROUP BY TaxonomyCode
  ORDER BY TOTAL_PROVIDERS DESC, TaxonomyCode NULLS LAST LIMIT 10""")
