"""The registered queries in SQL, written independently of the Spark code.

``_CHAIN`` builds the tables of all layers from the driver's tables, step by step; each
query selects from the end of the part it needs. Rounding goes through the decimal text of
a number, so that halves are rounded the way the text reads.
"""

from __future__ import annotations

import re

from carelake import fixed_values as fixed

AS_OF = "TIMESTAMP '2001-09-30 00:00:00'"


def _bare(text: str) -> str:
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def _list(values) -> str:
    """A list of fixed values as an SQL array."""
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values) + "]"


def _round(x: str, places: int) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {places}) AS DOUBLE)"


def _div(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0))"


def _cents(x: str) -> str:
    return f"CAST(CAST(sum(CAST(round({x} * 100) AS BIGINT)) AS BIGINT) / 100.0 AS DOUBLE)"


def _key(x: str, source: str = "clinic") -> str:
    return f"substr(sha256('{source}||' || CAST({x} AS VARCHAR)), 1, 32)"


def _person(number: str, turn: str) -> str:
    """Raw identifiers of a customer number, as columns."""
    person = f"({number} - {number} % 3)"
    digits = f"lpad(CAST({person} AS VARCHAR), 6, '0')"
    letters = f"translate(CAST({person} AS VARCHAR), '0123456789', 'abcdefghij')"
    birth = (
        f"(DATE '1940-01-01' + CAST(({person} * 37) % 25000 + "
        f"CASE WHEN {number} % 11 = 0 THEN 1 ELSE 0 END AS INTEGER))"
    )
    return f"""
      CASE WHEN {number} % 13 <> 0 THEN 'Ann-' || {letters} END AS patient_first_name,
      'O''Neil' AS patient_last_name,
      CASE WHEN {number} % 3 <> 2 THEN
             CASE WHEN {turn} % 2 = 0 THEN '  User' || {digits} || '@Example.COM '
                  ELSE 'user' || {digits} || '@example.com' END
           WHEN {number} % 2 = 0 THEN 'not an address' END AS patient_email,
      CASE WHEN {number} % 17 = 0 THEN '12345'
           WHEN {turn} % 5 = 0 THEN '0412 ' || substr({digits}, 1, 3) || ' ' || substr({digits}, 4, 3)
           WHEN {turn} % 5 = 1 THEN '+61 412 ' || {digits}
           WHEN {turn} % 5 = 2 THEN '0061412' || {digits}
           WHEN {turn} % 5 = 3 THEN '(04) 12-' || {digits}
           ELSE substr('0412' || {digits}, 2, 9) END AS patient_phone,
      CASE WHEN {number} % 7 <> 0 THEN strftime({birth}, '%Y-%m-%d') END AS patient_dob,
      '2' || lpad(CAST({person} % 300 AS VARCHAR), 3, '0') AS postcode"""


_IDENTIFIERS = """
      CASE WHEN contains(patient_email, '@') AND lower(trim(patient_email)) NOT LIKE '@%'
                AND lower(trim(patient_email)) NOT LIKE '%@'
           THEN lower(trim(patient_email)) END AS email_norm,
      CASE WHEN regexp_full_match(phone_d, '0[0-9]{9}') THEN phone_d END AS phone_norm,
      nullif(upper(regexp_replace(coalesce(patient_first_name, '') || coalesce(patient_last_name, ''),
                                  '[^A-Za-z]', '', 'g')), '') AS name_key,
      TRY_CAST(patient_dob AS DATE) AS date_of_birth,
      postcode"""

_PHONE_STEPS = """
  (SELECT *, CASE WHEN length(phone_c) = 9 AND phone_c NOT LIKE '0%' THEN '0' || phone_c ELSE phone_c END AS phone_d
   FROM (SELECT *, CASE WHEN phone_b LIKE '0061%' THEN '0' || substr(phone_b, 5)
                        WHEN phone_b LIKE '61%' AND length(phone_b) = 11 THEN '0' || substr(phone_b, 3)
                        ELSE phone_b END AS phone_c
         FROM (SELECT *, regexp_replace(patient_phone, '[^0-9]', '', 'g') AS phone_b FROM {table})))"""


def _clock(minute: str) -> str:
    return (
        f"lpad(CAST(({minute}) // 60 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST(({minute}) % 60 AS VARCHAR), 2, '0')"
    )


_START = "480 + 15 * (l_partkey % 40)"
_LEN = "CAST(l_quantity AS INTEGER)"
_IDS = "src_clinic_id src_practitioner_id src_service_id".split()


def _positions(column: str) -> str:
    return (
        f"(SELECT id, row_number() OVER (ORDER BY id) - 1 AS p FROM "
        f"(SELECT DISTINCT {column} AS id FROM appointment WHERE {column} <> ''))"
    )


_PRICES = _list(fee for _, fee, _, _ in fixed.SERVICES)
_NAMES = _list(
    f"{first} {last}"
    for first, last in zip(fixed.PRACTITIONER_FIRST_NAMES, fixed.PRACTITIONER_LAST_NAMES, strict=True)
)

_CHAIN: list[tuple[str, str]] = [
    ("feed", f"""
      SELECT l_orderkey * 10 + l_linenumber AS "ID",
        CASE WHEN l_partkey % 997 <> 0 THEN o_custkey END AS patientID,
        l_suppkey AS practitionerID,
        CASE WHEN l_partkey % 499 <> 0 THEN 1 + (l_suppkey + l_linenumber) % 25 END AS locationID,
        CASE WHEN l_partkey % 211 = 5 THEN NULL WHEN l_partkey % 211 = 6 THEN '31/02/2000'
             WHEN l_partkey % 211 = 7 THEN '' WHEN l_partkey % 211 = 8 THEN '  ' WHEN l_partkey % 211 = 9 THEN chr(9)
             WHEN l_partkey % 211 = 10 THEN chr(10) || strftime(l_shipdate, '%Y-%m-%d') || chr(9)
             ELSE strftime(l_shipdate, '%Y-%m-%d') END AS appointmentDate,
        CASE WHEN l_partkey % 223 = 0 THEN '25:99' WHEN l_partkey % 223 = 1 THEN '' WHEN l_partkey % 223 = 2 THEN ' '
             WHEN l_partkey % 223 = 3 THEN chr(9) WHEN l_partkey % 223 = 4 THEN chr(13) || chr(10)
             WHEN l_partkey % 223 = 5 THEN {_clock(_START)} || chr(13) || chr(10)
             ELSE {_clock(_START)} END AS appointmentStartTime,
        CASE WHEN {_LEN} < 48 THEN
          CASE WHEN {_LEN} = 47 THEN {_clock(_START + ' - 30')} ELSE {_clock(_START + ' + ' + _LEN)} END
        END AS appointmentEndTime,
        ['Initial', 'Standard', 'Extended'][l_partkey % 3 + 1] AS appointmentType,
        1 + l_partkey % 6 AS appointmentTypeID,
        CASE WHEN l_linenumber <= 6 THEN '1' ELSE '0' END AS arrived,
        CASE WHEN l_partkey % 2 = 0 THEN '1' ELSE '0' END AS invoiceGenerated,
        CASE WHEN l_orderkey % 11 = 0 THEN '1' ELSE '0' END AS "DNA",
        CASE WHEN l_partkey % 9 = 0 THEN '1' ELSE '0' END AS cancelled,
        CASE WHEN l_partkey % 9 = 0 THEN strftime(l_shipdate, '%Y-%m-%d') END AS cancellationDate,
        CASE WHEN l_partkey % 4 = 0 THEN 'patient called, sick' END AS "Notes",
        {_person('o_custkey', 'l_linenumber')},
        l_shipdate + to_minutes(l_partkey % 2880) AS modified,
        o_orderdate AS created,
        date_trunc('month', l_shipdate)::TIMESTAMP AS ingest_ts,
        'batch-' || (l_orderkey % 8) AS batch_id,
        sha256(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, {_LEN},
                         strftime(l_shipdate, '%Y-%m-%d'))) AS payload_hash
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    ("typed", f"""
      SELECT CAST("ID" AS VARCHAR) AS src_appointment_id, CAST(patientID AS VARCHAR) AS src_patient_id,
        CAST(practitionerID AS VARCHAR) AS src_practitioner_id, CAST(locationID AS VARCHAR) AS src_clinic_id,
        CAST(appointmentTypeID AS VARCHAR) AS src_service_id, appointmentType AS service_name,
        TRY_CAST(nullif({_bare('appointmentDate')}, '') || ' ' || nullif({_bare('appointmentStartTime')}, '') AS TIMESTAMP) AS start_ts,
        TRY_CAST(nullif({_bare('appointmentDate')}, '') || ' ' || nullif({_bare('appointmentEndTime')}, '') AS TIMESTAMP) AS end_ts,
        CAST(date_diff('minute', start_ts, end_ts) AS INTEGER) AS duration_min,
        CASE WHEN cancelled = '1' THEN 'cancelled' WHEN "DNA" = '1' THEN 'dna'
             WHEN arrived = '1' THEN 'completed' ELSE 'booked' END AS status,
        cancelled AS flag_cancelled_raw, "DNA" AS flag_dna_raw, arrived AS flag_arrived_raw,
        TRY_CAST(cancellationDate AS DATE) AS cancellation_date, "Notes" AS notes,
        invoiceGenerated AS flag_invoiced_raw,
        {_IDENTIFIERS},
        modified AS _source_updated_ts, created AS _source_created_ts, ingest_ts AS _ingest_ts,
        batch_id AS _batch_id, payload_hash AS _payload_hash
      FROM {_PHONE_STEPS.format(table='feed')}"""),
    ("latest", """
      SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY src_appointment_id
        ORDER BY _source_updated_ts DESC NULLS LAST, _ingest_ts DESC NULLS LAST,
                 _payload_hash DESC NULLS LAST) AS rn FROM typed) WHERE rn = 1"""),
    ("appointment", f"""
      SELECT * EXCLUDE (email_norm, phone_norm, name_key, date_of_birth, postcode, _payload_hash),
        {_key('src_appointment_id')} AS appointment_key, {_key('src_patient_id')} AS patient_key,
        {_key('src_clinic_id')} AS clinic_key, {_key('src_practitioner_id')} AS practitioner_key,
        status = 'completed' AS is_completed, status = 'dna' AS is_dna, status = 'cancelled' AS is_cancelled,
        false AS is_deleted, CAST(NULL AS TIMESTAMP) AS deleted_detected_at
      FROM latest WHERE src_appointment_id IS NOT NULL AND start_ts IS NOT NULL"""),
    ("party_candidate", """
      SELECT 'clinic' AS source, src_patient_id AS source_party_id, email_norm, phone_norm, name_key,
             date_of_birth, postcode
      FROM (SELECT *, row_number() OVER (PARTITION BY src_patient_id
              ORDER BY _source_updated_ts DESC NULLS LAST, _ingest_ts DESC NULLS LAST,
                       _payload_hash DESC NULLS LAST, src_appointment_id DESC NULLS LAST) AS rn FROM latest)
      WHERE rn = 1"""),
    ("patient_list", f"SELECT c_custkey, {_person('c_custkey', '(c_custkey + 1)')} FROM customer"),
    ("second_source", f"""
      SELECT 'crm' AS source, CAST(c_custkey AS VARCHAR) AS source_party_id, {_IDENTIFIERS}
      FROM {_PHONE_STEPS.format(table='patient_list')}"""),
    ("pool", """
      SELECT source || '||' || source_party_id AS party_key, email_norm AS e, phone_norm AS p, name_key AS n,
             date_of_birth AS d, postcode AS z
      FROM (SELECT * FROM party_candidate UNION ALL SELECT * FROM second_source)
      WHERE source_party_id IS NOT NULL"""),
    ("membership", """
      SELECT 'email_dob' AS rule, e AS k1, CAST(d AS VARCHAR) AS k2, '' AS k3, * FROM pool WHERE e IS NOT NULL AND d IS NOT NULL
      UNION ALL SELECT 'email', e, '', '', * FROM pool WHERE e IS NOT NULL
      UNION ALL SELECT 'phone_name', p, n, '', * FROM pool WHERE p IS NOT NULL AND n IS NOT NULL
      UNION ALL SELECT 'name_dob_postcode', n, CAST(d AS VARCHAR), z, * FROM pool
        WHERE n IS NOT NULL AND d IS NOT NULL AND z IS NOT NULL"""),
    ("member", """
      SELECT *, min(party_key) OVER (PARTITION BY rule, k1, k2, k3) AS anchor_key,
                count(*) OVER (PARTITION BY rule, k1, k2, k3) AS block_size FROM membership"""),
    ("link", """
      SELECT DISTINCT m.party_key, m.anchor_key,
        CASE WHEN m.e = a.e AND m.d = a.d THEN 0.99::DOUBLE WHEN m.e = a.e THEN 0.95::DOUBLE
             WHEN m.p = a.p AND m.n = a.n THEN 0.93::DOUBLE
             WHEN m.n = a.n AND m.d = a.d AND m.z = a.z THEN 0.88::DOUBLE END AS confidence
      FROM member m JOIN pool a ON a.party_key = m.anchor_key WHERE m.party_key <> m.anchor_key"""),
    ("dim_date", """
      SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
        CAST(date_trunc('month', d) AS DATE) AS month_start, strftime(d, '%Y-%m') AS month_label,
        year(d) || '-Q' || quarter(d) AS quarter, dayname(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
        CASE WHEN month(d) >= 7 THEN year(d) || '-' || (year(d) + 1)
             ELSE (year(d) - 1) || '-' || year(d) END AS fin_year
      FROM (SELECT CAST(unnest(generate_series(min(start_ts)::DATE, max(start_ts)::DATE, INTERVAL 1 DAY)) AS DATE) AS d
            FROM appointment)"""),
    ("dim_clinic", f"""
      SELECT id AS src_clinic_id,
        {_list(fixed.CLINIC_NAMES)}[p % 6 + 1] AS clinic_name,
        {_list(fixed.CLINIC_STATES)}[p % 6 + 1] AS state,
        CAST({_list(fixed.CLINIC_ROOMS)}[p % 6 + 1] AS INTEGER) AS treatment_rooms,
        '{fixed.CLINIC_TIMEZONE}' AS clinic_timezone, {_key('id')} AS clinic_key, p
      FROM {_positions('src_clinic_id')}"""),
    ("dim_practitioner", f"""
      SELECT q.id AS src_practitioner_id,
        {_NAMES}[q.p % 12 + 1] AS practitioner_name,
        {_list(name for name, _ in fixed.DISCIPLINES)}[q.p % 5 + 1] AS discipline,
        CAST({_list(cost for _, cost in fixed.DISCIPLINES)}[q.p % 5 + 1] AS DOUBLE) AS hourly_cost_synth,
        c.src_clinic_id AS home_clinic_id,
        CASE WHEN q.p % 4 = 0 THEN 0.6::DOUBLE ELSE 1.0::DOUBLE END AS fte, {_key('q.id')} AS practitioner_key
      FROM {_positions('src_practitioner_id')} q
      LEFT JOIN dim_clinic c ON c.p = q.p % (SELECT count(*) FROM dim_clinic)"""),
    ("dim_service", f"""
      SELECT id AS src_service_id,
        {_list(name for name, *_ in fixed.SERVICES)}[p % 6 + 1] AS service_name,
        CAST({_PRICES}[p % 6 + 1] AS DOUBLE) AS standard_fee_synth,
        CAST({_list(minutes for _, _, minutes, _ in fixed.SERVICES)}[p % 6 + 1] AS INTEGER) AS standard_duration_min,
        {_list(payer for *_, payer in fixed.SERVICES)}[p % 6 + 1] AS payer_type
      FROM {_positions('src_service_id')}"""),
    ("priced", f"""
      SELECT a.* EXCLUDE (service_name), s.service_name, s.payer_type, s.standard_fee_synth,
        p.practitioner_name, p.discipline, c.clinic_name, c.state,
        round(CASE WHEN status = 'completed' THEN s.standard_fee_synth
             WHEN status = 'dna' AND s.payer_type = 'Private' THEN s.standard_fee_synth * 0.5
             ELSE 0.0 END, 2) AS revenue_synth,
        round(CASE WHEN status IN ('completed', 'dna')
              THEN p.hourly_cost_synth * (coalesce(duration_min, 30) / 60.0) ELSE 0.0 END, 2) AS direct_cost_synth
      FROM appointment a LEFT JOIN dim_service s USING (src_service_id)
      LEFT JOIN dim_practitioner p USING (src_practitioner_id)
      LEFT JOIN dim_clinic c USING (src_clinic_id)"""),
    ("fact", """
      SELECT *, CAST(start_ts AS DATE) AS date_key, round(revenue_synth - direct_cost_synth, 2) AS margin_synth,
        CAST(date_trunc('month', start_ts) AS DATE) AS month_start, strftime(start_ts, '%Y-%m') AS month_label
      FROM priced"""),
    ("capacity", f"""
      SELECT practitioner_key, src_practitioner_id, home_clinic_id, fte, hourly_cost_synth, date_key, month_start,
        month_label, {_round('fte * 6.5', 2)} AS available_hours_synth, {_key('home_clinic_id')} AS clinic_key
      FROM dim_practitioner CROSS JOIN dim_date WHERE NOT is_weekend"""),
]


def _counts(*names: str) -> str:
    flag = {"completed": "is_completed", "dna": "is_dna", "cancelled": "is_cancelled"}
    return ", ".join(f"CAST(count(*) FILTER ({flag[n]}) AS BIGINT) AS appointments_{n}" for n in names)


_HOURS = _round("CAST(sum(coalesce(duration_min, 0)) AS DOUBLE) / 60", 2)
_PATIENTS = "count(DISTINCT patient_key) AS unique_patients"


def _capacity_by(key: str) -> str:
    return (
        f"SELECT {key}, month_start, {_cents('available_hours_synth')} AS available_hours "
        f"FROM capacity GROUP BY ALL"
    )


_CHAIN += [
    ("capacity_clinic_monthly", _capacity_by("clinic_key")),
    ("capacity_practitioner_monthly", _capacity_by("practitioner_key")),
    ("clinic_base", f"""
      SELECT clinic_key, clinic_name, state, month_start, month_label, count(*) AS appointments_total,
        {_counts('completed', 'dna', 'cancelled')}, {_PATIENTS}, {_cents('revenue_synth')} AS revenue,
        {_cents('direct_cost_synth')} AS direct_cost, {_cents('margin_synth')} AS margin, {_HOURS} AS delivered_hours
      FROM fact GROUP BY clinic_key, clinic_name, state, month_start, month_label"""),
    ("mart_clinic_monthly", f"""
      SELECT *, {_round('appointments_dna * revenue_per_appointment', 2)} AS revenue_lost_to_dna FROM (
        SELECT b.*, c.available_hours,
          {_round(_div('appointments_dna', 'appointments_total'), 4)} AS dna_rate,
          {_round(_div('appointments_cancelled', 'appointments_total'), 4)} AS cancellation_rate,
          {_round(_div('delivered_hours', 'available_hours'), 4)} AS utilisation_pct,
          {_round(_div('margin', 'revenue'), 4)} AS margin_pct,
          {_round(_div('revenue', 'appointments_total'), 2)} AS revenue_per_appointment
        FROM clinic_base b LEFT JOIN capacity_clinic_monthly c
          ON b.clinic_key = c.clinic_key AND b.month_start = c.month_start)"""),
    ("mart_practitioner_monthly", f"""
      SELECT b.*, c.available_hours,
        {_round(_div('delivered_hours', 'available_hours'), 4)} AS utilisation_pct,
        {_round(_div('appointments_dna', 'appointments_total'), 4)} AS dna_rate,
        {_round(_div('revenue', 'delivered_hours'), 2)} AS revenue_per_hour
      FROM (SELECT practitioner_key, practitioner_name, discipline, month_start, month_label,
              count(*) AS appointments_total, {_counts('completed', 'dna')}, {_PATIENTS},
              {_cents('revenue_synth')} AS revenue, {_cents('margin_synth')} AS margin, {_HOURS} AS delivered_hours
            FROM fact GROUP BY practitioner_key, practitioner_name, discipline, month_start, month_label) b
      LEFT JOIN capacity_practitioner_monthly c
        ON b.practitioner_key = c.practitioner_key AND b.month_start = c.month_start"""),
    ("mart_service_monthly", f"""
      SELECT *, {_round(_div('margin', 'revenue'), 4)} AS margin_pct FROM (
        SELECT service_name, payer_type, month_start, month_label, count(*) AS appointments_total,
          {_counts('completed')}, {_cents('revenue_synth')} AS revenue, {_cents('direct_cost_synth')} AS direct_cost,
          {_cents('margin_synth')} AS margin
        FROM fact GROUP BY service_name, payer_type, month_start, month_label)"""),
    ("gaps", """
      SELECT patient_key, src_patient_id, appointment_key, start_ts, clinic_name, discipline, revenue_synth,
        row_number() OVER w AS visit_seq, lag(start_ts) OVER w AS prev_visit,
        CAST(date_diff('day', CAST(lag(start_ts) OVER w AS DATE), CAST(start_ts AS DATE)) AS INTEGER) AS days_since_prev
      FROM fact WHERE is_completed
      WINDOW w AS (PARTITION BY patient_key ORDER BY start_ts, appointment_key)"""),
    ("summary", f"""
      SELECT *, CAST(date_diff('day', CAST(last_visit_ts AS DATE), CAST({AS_OF} AS DATE)) AS INTEGER)
                  AS days_since_last_visit,
        date_diff('day', CAST(last_visit_ts AS DATE), CAST({AS_OF} AS DATE)) > 90 AS is_lapsed,
        percent_rank() OVER (ORDER BY lifetime_revenue ASC NULLS FIRST) AS revenue_pctile
      FROM (SELECT patient_key, src_patient_id, count(*) AS completed_visits, min(start_ts) AS first_visit_ts,
              max(start_ts) AS last_visit_ts, {_cents('revenue_synth')} AS lifetime_revenue,
              {_round('avg(days_since_prev)', 1)} AS avg_days_between_visits,
              count(DISTINCT clinic_name) AS clinics_visited, count(DISTINCT discipline) AS disciplines_seen
            FROM gaps GROUP BY patient_key, src_patient_id)"""),
    ("mart_patient_summary", """
      SELECT *, CASE WHEN revenue_pctile >= 0.80 THEN 'High' WHEN revenue_pctile >= 0.40 THEN 'Medium'
                     ELSE 'Low' END AS value_band FROM summary"""),
    ("dna", f"""
      SELECT clinic_name, CAST(sum(appointments_dna) AS BIGINT) AS dna_count,
        CAST(sum(appointments_total) AS BIGINT) AS appointments_total, {_cents('revenue_lost_to_dna')} AS revenue_lost
      FROM mart_clinic_monthly GROUP BY clinic_name"""),
    ("event_batch", """
      SELECT event_id AS id, event_type AS entity, ts FROM events"""),
    ("mark", """
      SELECT 'clinic' AS source, entity, greatest(a.mark, coalesce(b.mark, a.mark)) AS high_water_mark,
             CASE WHEN b.mark IS NULL THEN 'run-1' ELSE 'run-2' END AS last_batch_id
      FROM (SELECT event_type AS entity, max(ts) AS mark FROM events
            WHERE event_id % 3 = 0 OR event_type = 'error' GROUP BY 1) a
      LEFT JOIN (SELECT event_type AS entity, max(ts) AS mark FROM events
                 WHERE event_id % 3 <> 0 AND event_type <> 'error' GROUP BY 1) b USING (entity)"""),
    ("ledger", """
      SELECT 'run-' || user_id AS batch_id, event_type, ts, event_id, props,
        event_type IN ('error', 'purchase') AS is_end FROM events"""),
    ("audit", """
      SELECT 'clinic' AS source, 'events' AS entity, s.batch_id,
        CASE WHEN f.ts IS NOT NULL THEN f.event_id % 5 END AS record_count,
        CASE WHEN f.ts IS NOT NULL THEN CAST(f.event_id % 3 AS INTEGER) END AS page_count,
        CASE f.event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCEEDED' ELSE 'RUNNING' END AS status,
        CASE WHEN f.event_type = 'error' THEN substr(repeat(f.props, 200), 1, 1000) END AS error_message,
        s.ts AS started_at, f.ts AS finished_at
      FROM (SELECT * FROM ledger WHERE NOT is_end) s
      ASOF LEFT JOIN (SELECT * FROM ledger WHERE is_end) f ON s.batch_id = f.batch_id AND s.ts < f.ts"""),
]


def _with_chain(select: str) -> str:
    """The statement, preceded by the steps of the chain that it needs."""
    needed, frontier = set(), [select]
    steps = dict(_CHAIN)
    while frontier:
        words = set(re.findall(r"\w+", frontier.pop()))
        for name in steps.keys() & words - needed:
            needed.add(name)
            frontier.append(steps[name])
    ctes = [f"{name} AS ({body})" for name, body in _CHAIN if name in needed]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + select


def _checks(rows: list[tuple[str, str, str, str, str]]) -> str:
    return "\n UNION ALL ".join(
        f"SELECT '{name}' AS check_name, '{severity}' AS severity, CAST({value} AS DOUBLE) AS value, "
        f"CAST({bound} AS DOUBLE) AS threshold, CAST({value} AS DOUBLE) {'>=' if name.endswith('non_zero') else '<='} "
        f"{bound} AS passed FROM {table}"
        for name, severity, value, bound, table in rows
    )


def _share(condition: str) -> str:
    return f"count(*) FILTER ({condition}) / CAST(count(*) AS DOUBLE)"


_FUTURE = f"start_ts > {AS_OF} + INTERVAL 365 DAY"
_BAD = "duration_min IS NULL OR duration_min <= 0 OR duration_min > 480"
_APPOINTMENT_CHECKS = [
    ("row_count_non_zero", "fail", "count(*)", "1", "appointment"),
    ("no_null_surrogate_keys", "fail", "count(*) FILTER (appointment_key IS NULL)", "0", "appointment"),
    ("surrogate_key_unique", "fail", "count(*) - count(DISTINCT appointment_key)", "0", "appointment"),
    ("clinic_key_present", "warn", _share("clinic_key IS NULL"), "0.01", "appointment"),
    ("booked_status_rate", "warn", _share("status = 'booked'"), "0.60", "appointment"),
    ("no_implausible_future_dates", "warn", f"count(*) FILTER ({_FUTURE})", "0", "appointment"),
    ("duration_plausible", "warn", _share(_BAD), "0.05", "appointment"),
]
_PARTY_CHECKS = [
    ("party_count_non_zero", "fail", "count(*)", "1", "party_candidate"),
    ("phone_normalisation_rate", "warn", _share("phone_norm IS NULL"), "0.30", "party_candidate"),
    ("email_normalisation_rate", "warn", _share("email_norm IS NULL"), "0.40", "party_candidate"),
    ("party_has_matchable_identifier", "warn",
     _share("phone_norm IS NULL AND email_norm IS NULL AND date_of_birth IS NULL"), "0.10", "party_candidate"),
    ("party_id_unique_per_source", "fail",
     "(SELECT count(*) FROM (SELECT 1 FROM party_candidate GROUP BY source, source_party_id HAVING count(*) > 1))",
     "0", "(SELECT 1)"),
]


def _monthly_checks() -> str:
    monthly = [(n, s, v, b, "appointment GROUP BY run_ts") for n, s, v, b, _ in _APPOINTMENT_CHECKS]
    body = _checks(monthly).replace("SELECT '", "SELECT run_ts, '")
    return (
        f"SELECT *, lag(value) OVER w AS previous_value, value - lag(value) OVER w AS change FROM ("
        f"{body.replace('FROM appointment', 'FROM (SELECT *, date_trunc(' + chr(39) + 'month' + chr(39) + ', start_ts)::TIMESTAMP AS run_ts FROM appointment)')}"
        f") WINDOW w AS (PARTITION BY check_name ORDER BY run_ts)"
    )


def _rollup(mart: str, key: str, counts: str, amounts: str, where: str = "") -> str:
    c = ", ".join(f"CAST(sum({x}) AS BIGINT) AS {x}" for x in counts.split())
    a = ", ".join(f"{_cents(x)} AS {x}" for x in amounts.split())
    pairs = [("dna_rate", "appointments_dna", "appointments_total"),
             ("cancellation_rate", "appointments_cancelled", "appointments_total"),
             ("utilisation_pct", "delivered_hours", "available_hours"), ("margin_pct", "margin", "revenue")]
    have = counts.split() + amounts.split()
    rates = ", ".join(f"{_round(_div(n, d), 4)} AS {r}" for r, n, d in pairs if n in have and d in have)
    return f"SELECT *, {rates} FROM (SELECT {key}, {c}, {a} FROM {mart} {where} GROUP BY {key})"


_CLINIC_ROLLUP = _rollup(
    "mart_clinic_monthly", "clinic_key",
    "appointments_total appointments_completed appointments_dna appointments_cancelled",
    "revenue direct_cost margin delivered_hours available_hours",
)
_KNOWN_STATUS = " ".join(
    f"WHEN lower(trim(raw_status)) = '{word}' THEN '{status}'" for word, status in fixed.STATUS_WORDS.items()
)
_EVENT_LINE = (
    """'{"ID":' || event_id || ',"entity":"' || event_type || '","userID":' || user_id || ',"value":' || value """
    """|| ',"lastModified":"' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '"}'"""
)


def all_oracles() -> dict[str, str]:
    """SQL by query name."""
    final = {
        "normalise_identifiers": "SELECT * FROM second_source",
        "canonical_status": f"""
            SELECT *, CASE {_KNOWN_STATUS} ELSE 'unknown' END AS status FROM (
              SELECT o_orderkey, CASE WHEN o_orderkey % 16 < 15 THEN
                ['Completed', ' attended ', 'DNA', 'no show', 'No_Show', 'Did Not Attend', 'canceled', 'CANCELLED',
                 'complete', 'arrived', 'booked', 'Confirmed', 'rescheduled', 'wibble', ''][o_orderkey % 16 + 1]
                END AS raw_status FROM orders)""",
        "surrogate_keys": f"""
            SELECT o_orderkey, {_key('o_orderkey')} AS order_key, {_key('o_orderkey', 'crm')} AS order_key_elsewhere,
              {_key('nullif(o_custkey % 10, 0)')} AS nullable_key FROM orders""",
        "compose_timestamp": """
            SELECT start_ts, duration_min, count(*) AS visits, count(end_ts) AS with_end FROM typed GROUP BY 1, 2""",
        "status_precedence": """
            SELECT flag_cancelled_raw AS cancelled, flag_dna_raw AS "DNA", flag_arrived_raw AS arrived, status,
              count(*) AS visits FROM typed GROUP BY 1, 2, 3, 4""",
        "visit_duration": """
            SELECT duration_min, count(*) AS visits, count(*) FILTER (start_ts IS NULL) AS without_start
            FROM typed GROUP BY 1""",
        "lww_dedupe": """
            SELECT src_appointment_id, src_patient_id, status, start_ts, _source_updated_ts, _payload_hash FROM latest""",
        "silver_appointment": "SELECT * FROM appointment",
        "silver_incremental": """
            SELECT appointment_key, src_appointment_id, start_ts, status, _source_updated_ts FROM appointment""",
        "party_candidate": "SELECT * FROM party_candidate",
        "deletion_sweep": f"""
            SELECT appointment_key, status, present IS NULL AS is_deleted,
              CASE WHEN present IS NULL THEN {AS_OF} END AS deleted_detected_at
            FROM appointment LEFT JOIN (
              SELECT DISTINCT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS src_appointment_id, true AS present
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P') USING (src_appointment_id)""",
        "dim_date": "SELECT * FROM dim_date",
        "dim_clinic": "SELECT * EXCLUDE (p) FROM dim_clinic",
        "dim_practitioner": "SELECT * FROM dim_practitioner",
        "dim_service": "SELECT * FROM dim_service",
        "fct_appointment": """
            SELECT appointment_key, patient_key, clinic_key, practitioner_key, src_appointment_id, src_patient_id,
              date_key, start_ts, end_ts, duration_min, status, is_completed, is_dna, is_cancelled, is_deleted,
              service_name, payer_type, standard_fee_synth, practitioner_name, discipline, clinic_name, state,
              revenue_synth, direct_cost_synth, margin_synth FROM fact""",
        "fct_capacity": "SELECT * FROM capacity",
        "capacity_clinic_monthly": "SELECT * FROM capacity_clinic_monthly",
        "capacity_practitioner_monthly": "SELECT * FROM capacity_practitioner_monthly",
        "mart_clinic_monthly": "SELECT * FROM mart_clinic_monthly",
        "mart_clinic_maintained": "SELECT * FROM mart_clinic_monthly",
        "mart_practitioner_monthly": "SELECT * FROM mart_practitioner_monthly",
        "mart_service_monthly": "SELECT * FROM mart_service_monthly",
        "visit_gaps": """
            SELECT patient_key, appointment_key, start_ts, visit_seq, prev_visit, days_since_prev FROM gaps""",
        "mart_patient_summary": "SELECT * FROM mart_patient_summary",
        "value_bands": f"""
            SELECT value_band, count(*) AS patients, min(revenue_pctile) AS from_pctile, max(revenue_pctile) AS to_pctile,
              {_cents('lifetime_revenue')} AS revenue, count(*) FILTER (is_lapsed) AS lapsed
            FROM mart_patient_summary GROUP BY 1""",
        "quality_checks": _checks(_APPOINTMENT_CHECKS + _PARTY_CHECKS),
        "duplicate_keys": """
            SELECT src_appointment_id, count(*) AS versions FROM typed GROUP BY 1 HAVING count(*) > 1""",
        "dq_trend": _monthly_checks(),
        "dq_history": f"""
            SELECT *, row_number() OVER (ORDER BY run_ts DESC, check_name) - 1 AS place
            FROM ({_checks(_APPOINTMENT_CHECKS + _PARTY_CHECKS)})
            CROSS JOIN (SELECT unnest([TIMESTAMP '2001-09-29 00:00:00', {AS_OF}]) AS run_ts)""",
        "response_records": """
            SELECT event_id AS "ID", event_type AS kind, value FROM events""",
        "reconcile": """
            SELECT 'appointment_count' AS check_name, 'visit day' AS grain, grain_value, source_value, platform_value,
              coalesce(platform_value, 0) - coalesce(source_value, 0) AS variance, 2.0::DOUBLE AS tolerance,
              abs(coalesce(platform_value, 0) - coalesce(source_value, 0)) <= 2 AS passed
            FROM (SELECT strftime(l_shipdate, '%Y-%m-%d') AS grain_value,
                    count(DISTINCT (l_orderkey, l_linenumber))::DOUBLE AS source_value FROM lineitem GROUP BY 1)
            FULL JOIN (SELECT strftime(start_ts, '%Y-%m-%d') AS grain_value, count(*)::DOUBLE AS platform_value
                       FROM appointment GROUP BY 1) USING (grain_value)""",
        "reconcile_rows": """
            WITH lines AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_orderkey * 10 + l_linenumber AS k FROM lineitem),
            changed AS (SELECT l_orderkey, l_linenumber, CASE WHEN k % 1009 = 2 THEN l_suppkey + 1 ELSE l_suppkey END AS l_suppkey,
                l_shipdate, k FROM lines WHERE k % 997 <> 1),
            platform AS (SELECT * FROM changed UNION ALL SELECT * FROM changed WHERE k % 1019 = 4
                UNION ALL SELECT -l_orderkey, l_linenumber, l_suppkey, l_shipdate, k FROM lines WHERE k % 1013 = 3),
            s AS (SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list((l_suppkey, l_shipdate))) AS v FROM lines GROUP BY 1, 2),
            p AS (SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list((l_suppkey, l_shipdate))) AS v FROM platform GROUP BY 1, 2)
            SELECT l_orderkey, l_linenumber, coalesce(s.n, 0) AS source_rows, coalesce(p.n, 0) AS platform_rows,
              CASE WHEN p.n IS NULL THEN 'missing' WHEN s.n IS NULL THEN 'unexpected' ELSE 'different' END AS finding
            FROM s FULL JOIN p USING (l_orderkey, l_linenumber) WHERE s.v IS DISTINCT FROM p.v""",
        "party_match_blocks": "SELECT party_key, rule, anchor_key, block_size FROM member WHERE block_size > 1",
        "party_match": "SELECT *, confidence >= 0.90 AS auto_link FROM link",
        "party_pair_scores": """
            SELECT source_party_id, confidence, coalesce(confidence >= 0.90, false) AS auto_link FROM (
              SELECT a.source_party_id, CASE
                WHEN a.email_norm = b.email_norm AND a.date_of_birth = b.date_of_birth THEN 0.99::DOUBLE
                WHEN a.email_norm = b.email_norm THEN 0.95::DOUBLE
                WHEN a.phone_norm = b.phone_norm AND a.name_key = b.name_key THEN 0.93::DOUBLE
                WHEN a.name_key = b.name_key AND a.date_of_birth = b.date_of_birth AND a.postcode = b.postcode
                  THEN 0.88::DOUBLE END AS confidence
              FROM party_candidate a JOIN second_source b USING (source_party_id))""",
        "status_counts": "SELECT status, count(*) AS visits FROM appointment GROUP BY 1",
        "dna_by_clinic": "SELECT * FROM dna",
        "dna_headline": f"""
            SELECT CAST(sum(dna_count) AS BIGINT) AS total_dna, {_cents('revenue_lost')} AS revenue_lost,
              first(clinic_name ORDER BY dna_count DESC, clinic_name) AS worst_clinic,
              first(dna_count ORDER BY dna_count DESC, clinic_name) AS worst_clinic_dna FROM dna""",
        "top_clinic_months": """
            SELECT month_label, clinic_key, clinic_name, appointments_total, revenue, margin, dna_rate, utilisation_pct
            FROM mart_clinic_monthly ORDER BY month_start DESC, revenue DESC NULLS LAST, clinic_key NULLS FIRST LIMIT 20""",
        "rollup_ratios": _CLINIC_ROLLUP,
        "rank_entities": _CLINIC_ROLLUP,
        "rank_future_excluded": _rollup(
            "mart_practitioner_monthly", "practitioner_key",
            "appointments_total appointments_completed appointments_dna",
            "revenue margin delivered_hours available_hours", "WHERE appointments_completed > 0",
        ),
        "normalise_rates": "SELECT clinic_key, month_label, " + ", ".join(
            f"CASE WHEN (SELECT max(abs({c})) FROM mart_clinic_monthly) <= 1.5 THEN {c} * 100 ELSE {c} END AS {c}"
            for c in ["dna_rate", "cancellation_rate", "utilisation_pct", "margin_pct"]
        ) + " FROM mart_clinic_monthly",
        "bronze_events": f"""
            SELECT CASE WHEN broken THEN NULL ELSE event_id END AS "ID", CASE WHEN broken THEN NULL ELSE event_type END AS entity,
              CASE WHEN broken OR wrong_type THEN NULL ELSE user_id END AS "userID",
              CASE WHEN broken THEN NULL ELSE value END AS value,
              CASE WHEN broken THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS "lastModified",
              CASE WHEN unknown THEN '{{"channel":"web"}}' WHEN wrong_type THEN '{{"userID":"u' || user_id || '"}}'
                   WHEN broken THEN '{{"_corrupt_record":"' || replace(payload, '"', '\\"') || '"}}' END AS _rescued_data,
              'clinic' AS _source, 'events' AS _entity,
              CASE WHEN event_id % 2 = 1 THEN 'run-2' ELSE 'run-1' END AS _batch_id, CAST(ts AS DATE) AS dt,
              payload AS _raw_payload, sha256(payload) AS _payload_hash
            FROM (SELECT *, CASE WHEN unknown THEN left(line, length(line) - 1) || ',"channel":"web"}}'
                WHEN wrong_type THEN replace(line, '"userID":' || user_id, '"userID":"u' || user_id || '"')
                WHEN broken THEN left(line, length(line) - 5) ELSE line END AS payload
              FROM (SELECT *, {_EVENT_LINE} AS line, event_id % 2 = 1 AND event_id % 97 = 1 AS unknown,
                  event_id % 2 = 1 AND event_id % 97 <> 1 AND event_id % 101 = 1 AS wrong_type,
                  event_id % 2 = 1 AND event_id % 97 <> 1 AND event_id % 101 <> 1 AND event_id % 103 = 1 AS broken
                FROM events))""",
        "bronze_report": """
            SELECT count(*) AS total_rows, count(*) FILTER (event_id % 103 = 1) AS rescued_rows FROM events""",
        "first_deliveries": f"""
            SELECT event_id AS "ID", event_type AS entity, user_id AS "userID", value,
              strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "lastModified",
              CASE WHEN ts <= to_timestamp(floor((SELECT avg(epoch(date_trunc('second', ts))) FROM events))) AT TIME ZONE 'UTC'
                THEN 'run-1' ELSE 'run-2' END AS _batch_id,
              CAST(ts AS DATE) AS dt, sha256({_EVENT_LINE}) AS _payload_hash
            FROM events""",
        "lookup_join": """
            SELECT status, count(*) AS visits, CASE status WHEN 'completed' THEN true WHEN 'dna' THEN false
              WHEN 'cancelled' THEN false END AS attended
            FROM appointment GROUP BY 1""",
        "watermark_state": """
            SELECT *, high_water_mark - INTERVAL 48 HOUR AS extract_from FROM mark""",
        "incremental_since": """
            SELECT event_id AS "ID", event_type AS entity, user_id AS "userID", value,
              strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "lastModified"
            FROM events JOIN mark ON event_type = entity WHERE ts >= high_water_mark - INTERVAL 48 HOUR""",
        "audit_state": "SELECT * FROM audit",
        "stale_runs": """
            SELECT batch_id, started_at, status, CASE WHEN finished_at IS NULL THEN 'never finished'
              ELSE 'no records' END AS reason
            FROM audit WHERE finished_at IS NULL OR (status = 'SUCCEEDED' AND record_count = 0)""",
        "gold_census": "\n UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}"
            for name, table in [
                ("dim_date", "dim_date"), ("dim_clinic", "dim_clinic"), ("dim_practitioner", "dim_practitioner"),
                ("dim_service", "dim_service"), ("fct_appointment", "fact"), ("fct_capacity", "capacity"),
                ("mart_clinic_monthly", "mart_clinic_monthly"),
                ("mart_practitioner_monthly", "mart_practitioner_monthly"),
                ("mart_service_monthly", "mart_service_monthly"), ("mart_patient_summary", "summary"),
            ]
        ),
    }
    oracles = {name: _with_chain(select) for name, select in final.items()}
    oracles["party_components"] = _components()
    return oracles


def _components() -> str:
    """Reachability over the links, which the blocks of a few records keep small."""
    chain = _with_chain("SELECT * FROM link, pool").removesuffix("SELECT * FROM link, pool").rstrip()
    return (
        chain.replace("WITH ", "WITH RECURSIVE ", 1)
        + """,
    edge AS (SELECT party_key AS a, anchor_key AS b FROM link WHERE confidence >= 0.90
             UNION SELECT anchor_key, party_key FROM link WHERE confidence >= 0.90),
    reach AS (SELECT party_key AS node, party_key AS other FROM pool
              UNION SELECT r.node, e.b FROM reach r JOIN edge e ON e.a = r.other)
    SELECT node, min(other) AS component FROM reach GROUP BY node"""
    )
