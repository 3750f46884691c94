"""SQL that DuckDB runs over the same tables, one statement per query.

The statements are written independently of the operators where that is
possible: eras and inpatient visits by counting starts and ends instead of by a
running maximum, documents by the columns they were made from.
"""

from __future__ import annotations

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, sql: str, *needs: str) -> None:
    _CTES[name] = (needs, sql)


def _sql(select: str, *needs: str) -> str:
    """``select`` preceded by the named subqueries and all they need, in order."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in _CTES[name][0]:
                add(other)

    for name in needs:
        add(name)
    parts = ", ".join(f"{n} as ({body})" for n, (_, body) in _CTES.items() if n in wanted)
    return f"with {parts} {select}" if parts else select


# -- vocabulary --------------------------------------------------------------

_cte(
    "pv",
    """select p_partkey, p_name, p_brand, p_type, p_size, cast(substr(p_brand, 7) as bigint) as b,
    cast(case p_type when 'ECONOMY' then 1 when 'LARGE' then 2 when 'MEDIUM' then 3 when 'PROMO' then 4
         when 'SMALL' then 5 when 'STANDARD' then 6 end as bigint) as t,
    case p_type when 'ECONOMY' then 'Observation' when 'LARGE' then 'Measurement' when 'MEDIUM' then 'Condition'
         when 'PROMO' then 'Procedure' when 'SMALL' then 'Drug' when 'STANDARD' then 'Device' end as domain_id
    from part""",
)
_cte(
    "concept",
    """select 10000000 + p_partkey as concept_id, p_name || ' ' || p_partkey as concept_name, domain_id,
        case when p_size <= 25 then 'SNOMED' else 'HCPCS' end as vocabulary_id,
        'Clinical Finding' as concept_class_id, case when p_size % 3 = 0 then 'S' end as standard_concept,
        cast(p_partkey as varchar) as concept_code, case when p_size % 10 = 0 then 'D' end as invalid_reason
    from pv
    union all select distinct 10000 + b * 10 + t, p_type || ' ' || p_brand, domain_id,
        case when b % 2 = 0 then 'SNOMED' else 'HCPCS' end, 'Disorder', 'S', 'G' || (10000 + b * 10 + t), null from pv
    union all select distinct 1000 + b, p_brand, 'Drug', 'RxNorm', 'Ingredient', 'S', 'B' || b, null from pv
    union all select 900000 + n_nationkey, n_name, 'Visit', 'UB04 Pt dis status', 'Visit', null,
        lpad(cast(n_nationkey as varchar), 2, '0'), case when n_regionkey = 4 then 'D' end from nation
    union all select 910000 + r_regionkey, r_name, 'Visit', 'CMS Place of Service', 'Visit',
        case when r_regionkey = 3 then null else 'S' end, cast(r_regionkey as varchar), null from region
    union all select 920000 + n_nationkey, lower(n_name), 'Geography', 'OSM', '4th level',
        case when n_regionkey = 2 then null else 'S' end, cast(n_nationkey as varchar), null from nation""",
    "pv",
)
_cte(
    "rel",
    """select 10000000 + p_partkey as concept_id_1, 10000 + b * 10 + t as concept_id_2,
        case when p_size % 11 = 0 then 'maps to' else 'Maps to' end as relationship_id,
        case when p_size % 7 = 0 then 'D' end as invalid_reason
    from pv where p_size % 3 <> 0
    union all select 10000000 + p_partkey, 1000 + b, case when p_size % 11 = 0 then 'maps to' else 'Maps to' end,
        case when p_size % 7 = 0 then 'D' end from pv where p_size % 3 <> 0 and p_size between 40 and 45
    union all select 900000 + n_nationkey, 910000 + n_regionkey, 'Maps to', null from nation where n_regionkey <> 1
    union all select distinct 10000 + b * 10 + t, 1000 + b, 'Is a', null from pv""",
    "pv",
)
_cte(
    "closure",
    """select 10000000 + p_partkey as a, 10000000 + p_partkey as d, 0 as n from pv
    union select 10000 + b * 10 + t, 10000000 + p_partkey, 1 from pv
    union select 1000 + b, 10000000 + p_partkey, 2 from pv
    union select 10000 + b * 10 + t, 10000 + b * 10 + t, 0 from pv
    union select 1000 + b, 10000 + b * 10 + t, 1 from pv
    union select 1000 + b, 1000 + b, 0 from pv""",
    "pv",
)
_cte(
    "syn",
    "select 10000000 + p_partkey as concept_id, 'syn ' || p_type || ' ' || p_name as concept_synonym_name from pv",
    "pv",
)
_cte(
    "custom",
    """select s_name as source_code, cast(0 as bigint) as source_concept_id, 'SUPPLIER' as source_vocabulary_id,
    1000 + s_nationkey + 1 as target_concept_id, case when s_acctbal < 0 then 'D' end as invalid_reason from supplier""",
)
_cte(
    "std_map",
    """select c.concept_code as source_code, c.concept_id as source_concept_id,
        c.vocabulary_id as source_vocabulary_id, c.domain_id as source_domain_id, t.concept_id as target_concept_id,
        t.domain_id as target_domain_id, t.vocabulary_id as target_vocabulary_id,
        t.standard_concept as target_standard_concept, t.invalid_reason as target_invalid_reason
    from concept c join rel r on r.concept_id_1 = c.concept_id and lower(r.relationship_id) = 'maps to'
        and r.invalid_reason is null
    join concept t on t.concept_id = r.concept_id_2
    union all
    select m.source_code, m.source_concept_id, m.source_vocabulary_id, null, t.concept_id, t.domain_id,
        t.vocabulary_id, t.standard_concept, t.invalid_reason
    from custom m join concept t on t.concept_id = m.target_concept_id where m.invalid_reason is null""",
    "concept",
    "rel",
    "custom",
)
_cte(
    "src_map",
    """select concept_code as source_code, concept_id as source_concept_id, vocabulary_id as source_vocabulary_id,
        domain_id as source_domain_id, concept_id as target_concept_id, vocabulary_id as target_vocabulary_id
    from concept
    union all
    select m.source_code, m.source_concept_id, m.source_vocabulary_id, null, t.concept_id, t.vocabulary_id
    from custom m join concept t on t.concept_id = m.target_concept_id where m.invalid_reason is null""",
    "concept",
    "custom",
)

# -- intervals ---------------------------------------------------------------

_cte(
    "ev",
    """select event_id, user_id as person_id, event_type as concept, cast(ts as date) as start_date,
    cast(ts as date) + cast(floor(value) as integer) % 3 as end_date from events""",
)


def _islands(name: str, source: str, keys: list[str], gap: int, aggregates: str, *needs: str) -> None:
    """Islands of ``source`` (keys, start_date, end_date, ...) by counting starts and ends.

    An island ends where as many intervals have ended as have started; starts
    come first among equal dates. ``aggregates`` is evaluated per island.
    """
    k = ", ".join(keys)
    on = " and ".join(f"r.{c} = e.{c}" for c in keys)
    r = ", ".join(f"r.{c}" for c in keys)
    _cte(f"{name}_rows", f"select *, row_number() over () as rid from {source}", source, *needs)
    _cte(
        f"{name}_marks",
        f"""select {k}, start_date as day, 0 as kind,
            row_number() over (partition by {k} order by start_date) as started from {name}_rows
        union all select {k}, end_date + {gap}, 1, null from {name}_rows""",
        f"{name}_rows",
    )
    _cte(
        f"{name}_ends",
        f"""select {k}, day - {gap} as island_end from (
            select {k}, day,
                max(started) over (partition by {k} order by day, kind rows unbounded preceding) as started,
                row_number() over (partition by {k} order by day, kind) as seen
            from {name}_marks) where 2 * started = seen""",
        f"{name}_marks",
    )
    _cte(
        f"{name}_placed",
        f"""select r.rid, min(e.island_end) as island_end from {name}_rows r
        join {name}_ends e on {on} and e.island_end >= r.start_date group by r.rid""",
        f"{name}_rows",
        f"{name}_ends",
    )
    _cte(
        name,
        f"""select {r}, min(r.start_date) as start_date, p.island_end as end_date{', ' + aggregates if aggregates else ''}
        from {name}_rows r join {name}_placed p on p.rid = r.rid group by {r}, p.island_end""",
        f"{name}_placed",
    )


for _gap in (0, 1, 2):
    _islands(f"eras_{_gap}", "ev", ["person_id", "concept"], _gap, "count(*) as n_events")

_cte(
    "exposures",
    """select o_custkey as person_id,
        case when l_linestatus = 'O' and l_returnflag = 'N' then 0 else 10000000 + l_partkey end as drug_concept_id,
        cast(l_shipdate as date) as start_date,
        case when l_returnflag = 'R' then cast(l_shipdate as date) + cast(l_quantity as integer) % 30 end as given_end,
        case when l_linestatus = 'F' and l_returnflag = 'A' then null else cast(l_quantity as integer) % 40 - 2 end
            as days_supply
    from lineitem join orders on l_orderkey = o_orderkey""",
)
_cte(
    "ing_map",
    """select distinct x.drug_concept_id, c.concept_id as ingredient_concept_id
    from exposures x join closure k on k.d = x.drug_concept_id join concept c on c.concept_id = k.a
    where c.vocabulary_id = 'RxNorm' and c.concept_class_id = 'Ingredient' and x.drug_concept_id <> 0""",
    "exposures",
    "closure",
    "concept",
)
_cte(
    "ing_exp",
    """select x.person_id, m.ingredient_concept_id, x.start_date,
        coalesce(x.given_end, nullif(x.start_date + x.days_supply, x.start_date), x.start_date + 1) as end_date
    from exposures x join ing_map m on m.drug_concept_id = x.drug_concept_id
    where x.drug_concept_id <> 0 and coalesce(x.days_supply, 0) >= 0""",
    "exposures",
    "ing_map",
)
_ING = ["person_id", "ingredient_concept_id"]
_islands("sub_exp", "ing_exp", _ING, 0, "count(*) as drug_exposure_count")
_cte(
    "sub_days",
    "select *, cast(date_diff('day', start_date, end_date) as bigint) as days_exposed from sub_exp",
    "sub_exp",
)
for _gap in (30, 180):
    _islands(
        f"drug_eras_{_gap}",
        "sub_days",
        _ING,
        _gap,
        "cast(sum(drug_exposure_count) as bigint) as drug_exposure_count, cast(sum(days_exposed) as bigint) as days_exposed",
    )
_ERA = """person_id, ingredient_concept_id as drug_concept_id, start_date as drug_era_start_date,
    end_date as drug_era_end_date, drug_exposure_count,
    cast(date_diff('day', start_date, end_date) - days_exposed as bigint) as gap_days"""

_EVENT_CONCEPT = """case {0} when 'purchase' then 1 when 'error' then 2 when 'signup' then 3 when 'view' then 4
    when 'click' then 5 end"""
_cte(
    "cond",
    f"""select person_id, cast({_EVENT_CONCEPT.format('concept')} as bigint) as condition_concept_id, start_date,
        case when concept = 'purchase' then start_date + 1 else end_date end as end_date,
        case when concept = 'purchase' then null else end_date end as given_end from ev""",
    "ev",
)
for _gap in (1, 30):
    _islands(
        f"cond_eras_{_gap}", "cond", ["person_id", "condition_concept_id"], _gap, "count(*) as condition_occurrence_count"
    )
_COND_ERA = """person_id, condition_concept_id, start_date as condition_era_start_date,
    end_date as condition_era_end_date, condition_occurrence_count"""

# -- encounters, visits ------------------------------------------------------

_cte(
    "ev_enc",
    """select event_id as encounter_id, cast(user_id as varchar) as patient,
        case event_type when 'purchase' then 'inpatient' when 'error' then 'emergency' when 'signup' then 'urgentcare'
            when 'view' then 'ambulatory' when 'click' then 'wellness' end as encounterclass,
        cast(ts as date) as start_date, cast(ts as date) + cast(floor(value) as integer) % 3 as stop_date,
        case event_type when 'view' then ' ' when 'click' then null
            else ' ' || (cast(floor(value) as integer) % 30) end as discharge
    from events""",
)
_cte(
    "ord_enc",
    """select o_orderkey as encounter_id, cast(o_custkey as varchar) as patient,
        case o_orderpriority when '1-URGENT' then 'emergency' when '2-HIGH' then 'inpatient'
            when '3-MEDIUM' then 'urgentcare' when '4-NOT SPECIFIED' then 'ambulatory' when '5-LOW' then 'wellness' end
            as encounterclass,
        cast(o_orderdate as date) as start_date,
        cast(o_orderdate as date) + cast(floor(o_totalprice) as integer) % 40 as stop_date,
        cast(cast(floor(o_totalprice) as bigint) % 120 as varchar) as provider,
        case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then '308646001' else '185345009' end as code,
        cast(cast(floor(o_totalprice) as bigint) % 2000 as varchar) as reasoncode
    from orders""",
)
_cte("early_enc", "select * from ev_enc where start_date < (select max(start_date) - 6 from ev_enc)", "ev_enc")
_GROUP = """case when {0} = 'inpatient' then 'inpatient' when {0} in ('emergency', 'urgent', 'urgentcare') then 'emergency'
    when {0} in ('ambulatory', 'wellness', 'outpatient') then 'outpatient' end"""
_PRIORITY = f"""case when visit_occurrence_id_new is null or {_GROUP.format('encounterclass')} is null then 99
    when {_GROUP.format('visit_type')} = 'inpatient' then 1
    when {_GROUP.format('encounterclass')} = {_GROUP.format('visit_type')} then 2 else 99 end"""
for _p in ("ev", "ord", "early"):
    _cte(
        f"{_p}_ip_in",
        f"select encounter_id, patient, encounterclass, start_date, stop_date as end_date from {_p}_enc "
        "where encounterclass = 'inpatient'",
        f"{_p}_enc",
    )
    _islands(f"{_p}_ip", f"{_p}_ip_in", ["patient", "encounterclass"], 1, "min(r.encounter_id) as encounter_id")
    _cte(
        f"{_p}_visits",
        f"""select row_number() over (order by patient, encounterclass, visit_start_date, encounter_id)
            as visit_occurrence_id, * from (
            select encounter_id, patient, encounterclass, start_date as visit_start_date, end_date as visit_end_date
            from {_p}_ip
            union all
            select min(encounter_id), patient, encounterclass, start_date, max(stop_date) from {_p}_enc
            where encounterclass in ('emergency', 'urgent', 'urgentcare', 'ambulatory', 'wellness', 'outpatient')
            group by patient, encounterclass, start_date)""",
        f"{_p}_ip",
    )
    _cte(
        f"{_p}_assign",
        f"""select e.encounter_id, e.patient, e.encounterclass, e.start_date, e.stop_date,
            v.visit_occurrence_id as visit_occurrence_id_new, v.encounterclass as visit_type,
            v.visit_start_date, v.visit_end_date
        from {_p}_enc e left join {_p}_visits v on v.patient = e.patient
            and e.start_date >= v.visit_start_date and e.stop_date <= v.visit_end_date""",
        f"{_p}_visits",
    )
    _cte(
        f"{_p}_final",
        f"""select encounter_id, visit_occurrence_id_new from (
            select *, row_number() over (partition by encounter_id order by {_PRIORITY},
                visit_start_date nulls first, visit_end_date nulls first, visit_occurrence_id_new nulls first) as rn
            from {_p}_assign) where rn = 1""",
        f"{_p}_assign",
    )

_BORN = "(date '1930-01-01' + cast(c_custkey % 30000 as integer))"
_DIED = "(date '2000-01-01' + cast(floor(c_acctbal) as integer))"
_cte(
    "persons",
    f"""select row_number() over (order by cast(c_custkey as varchar)) as person_id,
        cast(c_custkey as varchar) as person_source_value, {_BORN} as born,
        case when c_acctbal < 0 or c_acctbal > 8000 then {_DIED} end as died,
        case c_mktsegment when 'MACHINERY' then 'M' when 'FURNITURE' then 'f' when 'BUILDING' then 'F'
            when 'AUTOMOBILE' then 'M' end as gender, c_nationkey
    from customer join nation on c_nationkey = n_nationkey""",
)
_cte(
    "locations",
    """select row_number() over (order by state, county) as location_id, state, county,
        state || '|' || county as location_source_value
    from (select distinct 'N' || n_nationkey as state, cast(n_regionkey as varchar) as county
          from customer join nation on c_nationkey = n_nationkey)""",
)
_cte(
    "providers",
    """select row_number() over (order by provider_source_value, provider_name) as provider_id, *
    from (select distinct cast(s_suppkey as varchar) as provider_source_value, s_name as provider_name from supplier)""",
)
_VISIT_CONCEPT = """case encounterclass when 'inpatient' then 9201 when 'ambulatory' then 9202 when 'outpatient' then 9202
    when 'wellness' then 9202 when 'emergency' then 9203 when 'urgent' then 9203 when 'urgentcare' then 8782 else 0 end"""
_cte(
    "ord_occurrence",
    f"""select v.visit_occurrence_id, p.person_id, {_VISIT_CONCEPT} as visit_concept_id, v.visit_start_date,
        v.visit_end_date, 32827 as visit_type_concept_id, cast(v.encounter_id as varchar) as visit_source_value,
        cast(0 as bigint) as discharged_to_concept_id, cast(null as varchar) as discharged_to_source_value
    from ord_visits v join persons p on p.person_source_value = v.patient
    where v.visit_occurrence_id in (select visit_occurrence_id_new from ord_final)""",
    "ord_visits",
    "ord_final",
    "persons",
)
_cte(
    "discharged",
    """select f.visit_occurrence_id_new as visit_occurrence_id,
        max(case when length(trim(e.discharge)) = 1 then '0' || trim(e.discharge) else nullif(trim(e.discharge), '') end)
            as discharge
    from ev_final f join ev_enc e on e.encounter_id = f.encounter_id
    where f.visit_occurrence_id_new is not null
    group by 1 having max(nullif(trim(e.discharge), '')) is not null""",
    "ev_final",
    "ev_enc",
)
_cte(
    "dis_concepts",
    """select u.concept_code as discharge, coalesce(min(s.concept_id), min(u.concept_id)) as concept_id
    from concept u
    left join rel r on r.concept_id_1 = u.concept_id and r.relationship_id = 'Maps to' and r.invalid_reason is null
    left join concept s on s.concept_id = r.concept_id_2 and s.standard_concept = 'S' and s.invalid_reason is null
    where u.vocabulary_id = 'UB04 Pt dis status' and u.invalid_reason is null group by 1""",
    "concept",
    "rel",
)
_cte(
    "enriched",
    f"""select v.visit_occurrence_id, c_custkey as person_id, {_VISIT_CONCEPT} as visit_concept_id,
        v.visit_start_date, v.visit_end_date, 32827 as visit_type_concept_id,
        cast(v.encounter_id as varchar) as visit_source_value,
        cast(case when d.discharge is null then 0 else coalesce(k.concept_id, 0) end as bigint) as discharged_to_concept_id,
        d.discharge as discharged_to_source_value
    from ev_visits v join customer on cast(c_custkey as varchar) = v.patient
    left join discharged d on d.visit_occurrence_id = v.visit_occurrence_id
    left join dis_concepts k on k.discharge = d.discharge
    where v.visit_occurrence_id in (select visit_occurrence_id_new from ev_final)""",
    "ev_visits",
    "discharged",
    "dis_concepts",
)

# -- coded events ------------------------------------------------------------

_cte(
    "coded",
    """select case when l_linenumber = 7 then cast(l_suppkey as varchar) else cast(o_custkey as varchar) end as patient,
        l_orderkey as encounter, cast(l_partkey as varchar) as code, cast(l_shipdate as date) as date,
        case when l_returnflag = 'R' then cast(l_shipdate as date) + cast(l_quantity as integer) % 30 end as stop_date,
        case when l_returnflag = 'N' then l_returnflag || '-' || l_linestatus
            else cast(cast(l_quantity as integer) as varchar) end as value,
        repeat(l_linestatus, l_linenumber * 10) as units
    from lineitem join orders on l_orderkey = o_orderkey""",
)
_cte(
    "mapped",
    """select p.person_id, m.target_concept_id, m.target_domain_id, s.source_concept_id,
        case when e.patient = o.patient then pr.provider_id end as provider_id,
        f.visit_occurrence_id_new as visit_occurrence_id, f.visit_occurrence_id_new + 1000000 as visit_detail_id, o.*
    from coded o
    join std_map m on m.source_code = o.code and m.target_vocabulary_id in ('SNOMED', 'HCPCS')
        and m.target_standard_concept = 'S' and m.target_invalid_reason is null
    join src_map s on s.source_code = o.code and s.source_vocabulary_id = m.target_vocabulary_id
        and s.source_domain_id = m.target_domain_id
    join persons p on p.person_source_value = o.patient
    left join ord_final f on f.encounter_id = o.encounter
    left join ord_enc e on e.encounter_id = o.encounter
    left join providers pr on pr.provider_source_value = e.provider""",
    "coded",
    "std_map",
    "src_map",
    "persons",
    "ord_final",
    "providers",
)


def _domain(prefix: str, domain: str, columns: str, type_concept: int = 32827) -> str:
    return _sql(
        f"""select person_id, target_concept_id as {prefix}_concept_id, {type_concept} as {prefix}_type_concept_id,
        provider_id, visit_occurrence_id, visit_detail_id, code as {prefix}_source_value,
        source_concept_id as {prefix}_source_concept_id, {columns} from mapped where target_domain_id = '{domain}'""",
        "mapped",
    )


# -- payers and costs --------------------------------------------------------

_cte(
    "plans",
    """select row_number() over (order by person_id, payer_plan_period_start_date, payer_plan_period_end_date,
            payer_source_value) as payer_plan_period_id, * from (
        select distinct p.person_id, cast(o_orderdate as date) as payer_plan_period_start_date,
            cast(o_orderdate as date) + cast(floor(o_totalprice) as integer) % 365 as payer_plan_period_end_date,
            0 as payer_concept_id, r_name as payer_source_value, 0 as plan_concept_id
        from orders join region on cast(r_regionkey as varchar) = substr(o_orderpriority, 1, 1)
        join persons p on p.person_source_value = cast(o_custkey as varchar))""",
    "persons",
)
_cte(
    "sums",
    """select l_orderkey as claim_id,
        cast(sum(case when l_returnflag = 'A' then cast(l_extendedprice as decimal(18, 4)) end) as double) as total_charge,
        cast(sum(case when l_returnflag = 'R' then cast(l_extendedprice as decimal(18, 4)) end) as double) as total_paid
    from lineitem group by 1""",
)
_cte(
    "costs",
    """select o.encounter_id as claim_id, p.person_id, o.encounter_id, o.start_date as service_date, s.total_charge,
        s.total_paid, (select min(q.payer_plan_period_id) from plans q where q.person_id = p.person_id
            and o.start_date between q.payer_plan_period_start_date and q.payer_plan_period_end_date)
            as payer_plan_period_id
    from ord_enc o join persons p on p.person_source_value = o.patient join sums s on s.claim_id = o.encounter_id""",
    "ord_enc",
    "persons",
    "plans",
    "sums",
)
_cte(
    "billed",
    """select row_number() over (partition by target_domain_id order by person_id, encounter, code, date) as event_id, *
    from (select distinct target_domain_id, person_id, encounter, code, date from mapped
          where target_domain_id in ('Condition', 'Procedure', 'Drug', 'Device'))""",
    "mapped",
)

# -- cohorts -----------------------------------------------------------------

_cte(
    "cohort",
    f"""select r_name as study, {_EVENT_CONCEPT.format('event_type')} as cohort_id, user_id as subject_id,
        cast(ts as date) as start_date, cast(ts as date) + cast(floor(value) as integer) % 3 as end_date
    from events join customer on c_custkey = user_id join nation on n_nationkey = c_nationkey
    join region on r_regionkey = n_regionkey""",
)
_cte(
    "studies",
    """select r_name as study, case when r_name = 'EUROPE' then null else 1 end as target_id,
        cast(5 + r_regionkey * 10 as bigint) as min_target,
        cast(case when r_regionkey = 2 then 10 else 20 end as bigint) as min_outcome, cast(1 as bigint) as min_covariate
    from region""",
)
_cte(
    "manifest",
    """select r_name as study, cast(i as integer) as cohort_id, 'cohort ' || i as cohort_name, i in (2, 6) as is_outcome,
        i = 6 as expected_empty, case when i = 5 and r_name = 'ASIA' then 'FAILED' end as failed, i = 4 as hand_authored
    from region, range(1, 7) t(i)""",
)
_cte(
    "counts",
    """select c.study, c.cohort_id, count(distinct c.subject_id) as subjects,
        count(distinct t.subject_id) as subjects_in_target
    from cohort c left join studies s on s.study = c.study
    left join cohort t on t.study = c.study and t.subject_id = c.subject_id and t.cohort_id = s.target_id
    group by 1, 2""",
    "cohort",
    "studies",
)
_cte(
    "judged",
    """select study, cohort_id, cohort_name, role, subjects, subjects_in_target, threshold, metric,
        case when failed is null and coalesce(subjects_in_target, subjects) >= threshold then 'PASS' else 'FAIL' end
            as status,
        concat_ws('; ', 'generation failed: ' || failed,
            case when expected_empty then 'expected empty on synthetic data ('
                || coalesce(subjects_in_target, subjects) || ' found)' end,
            case when hand_authored then 'hand-authored: checked on its placeholder definition' end) as note,
        target_id
    from (
        select m.*, s.target_id,
            case when m.cohort_id = s.target_id then 'target' when m.is_outcome then 'outcome' else 'covariate' end as role,
            coalesce(c.subjects, 0) as subjects,
            case when m.is_outcome and coalesce(m.cohort_id <> s.target_id, true)
                then coalesce(c.subjects_in_target, 0) end as subjects_in_target,
            case when m.expected_empty then 0 when m.cohort_id = s.target_id then s.min_target
                when m.is_outcome then s.min_outcome else s.min_covariate end as threshold,
            case when m.is_outcome then 'subjects_in_target' else 'subjects' end as metric
        from manifest m join studies s on s.study = m.study
        left join counts c on c.study = m.study and c.cohort_id = m.cohort_id)""",
    "manifest",
    "counts",
)
_cte(
    "periods",
    "select person_id, min(start_date) as period_start, max(end_date) as period_end from ev group by 1",
    "ev",
)
_cte(
    "entries",
    f"""select r_name as study, d.c as cohort_id, e.person_id as subject_id, e.start_date, e.end_date, p.period_end
    from ev e join periods p on p.person_id = e.person_id
    join (values (1, 1), (2, 2), (3, 4), (3, 5)) d(c, k) on d.k = {_EVENT_CONCEPT.format('e.concept')}
    cross join region
    where e.start_date >= p.period_start + r_regionkey
        and e.start_date <= p.period_end - (case when d.c = 3 then 2 else 0 end)""",
    "ev",
    "periods",
)
_cte(
    "included",
    """select study, cohort_id, subject_id, start_date, end_date from entries n
    where cohort_id <> 3 or (
        (select count(*) from ev where person_id = n.subject_id and concept = 'error') >= 1
        and (select count(*) from ev where person_id = n.subject_id and concept = 'purchase')
            >= 10 + (select r_regionkey from region where r_name = n.study))""",
    "entries",
    "ev",
)


def _limited(name: str, source: str, end: str) -> None:
    _cte(
        name,
        f"""select study, cohort_id, subject_id, start_date, {end} as end_date from {source} where cohort_id <> 1
        union all
        select study, cohort_id, subject_id, start_date, end_date from (
            select study, cohort_id, subject_id, start_date, {end} as end_date, row_number() over (
                partition by study, cohort_id, subject_id order by start_date, {end}) as rn
            from {source} where cohort_id = 1) where rn = 1""",
        source,
    )


_COHORT = ["study", "cohort_id", "subject_id"]
_limited("limited", "included", "end_date")
_limited("limited_open", "entries", "period_end")
_islands("instantiated", "limited", _COHORT, 1, "")
_islands("instantiated_open", "limited_open", _COHORT, 0, "")
_islands("cohort_eras", "cohort", _COHORT, 2, "")
_COHORT_ROW = "study, cohort_id, subject_id, start_date as cohort_start_date, end_date as cohort_end_date"

_cte(
    "win_periods",
    """select person_id, a as start_date, case when person_id % 3 = 0 then m + 2 else m - 1 end as end_date
    from (select person_id, period_start as a, period_start + cast(floor((period_end - period_start) / 2) as integer) as m from periods)
    where case when person_id % 3 = 0 then m + 2 else m - 1 end >= a
    union all
    select person_id, case when person_id % 3 = 1 then m + 1 else m end as s,
        case when person_id % 7 = 0 or person_id % 11 = 0 then date '9999-12-31' else b end
    from (select person_id, period_end as b, period_start + cast(floor((period_end - period_start) / 2) as integer) as m from periods)
    where case when person_id % 7 = 0 or person_id % 11 = 0 then date '9999-12-31' else b end >= case when person_id % 3 = 1 then m + 1 else m end""",
    "periods",
)
_cte(
    "win_joined",
    """select person_id, min(start_date) as period_start, max(end_date) as period_end from (
        select *, sum(fresh) over (partition by person_id order by start_date, end_date rows unbounded preceding) as island from (
            select *, case when start_date <= date_add(max(end_date) over (partition by person_id order by start_date, end_date
                rows between unbounded preceding and 1 preceding), interval 1 day) then 0 else 1 end as fresh from win_periods))
    group by person_id, island""",
    "win_periods",
)
_cte(
    "win_timed",
    """select *, case when risk_end is null then observed_end
            else least(observed_end, cast(case when risk_end > 3000000 then timestamp '9999-12-31' when from_end
                then greatest(index_date, coalesce(end_date, period_end)) + risk_end else index_date + risk_end end as date)) end as risk_end_date
    from (
        select t.study, t.target_id, t.subject_id, t.index_date, t.end_date, o.outcome_id, p.period_start, p.period_end, s.*  exclude (study),
            cast(t.index_date + s.risk_start as date) as risk_start_date,
            least(coalesce(p.period_end, date '9999-12-31'), coalesce(
                (select min(d.end_date) from ev d where d.concept = 'signup' and d.person_id = t.subject_id and d.person_id % 4 = 0),
                date '9999-12-31')) as observed_end
        from (select study, 1 as target_id, subject_id, start_date as index_date,
                max(case when subject_id % 5 <> 0 then end_date end) as end_date
            from cohort where cohort_id = 1 group by study, subject_id, start_date) t
        join (select r_name as study, r_regionkey as prior_days, case when r_regionkey <> 4 then 2 * r_regionkey end as washout_days,
                case when r_regionkey = 3 then 0 else 1 end as risk_start,
                case r_regionkey when 1 then 9000000 when 2 then null else 10 end as risk_end,
                r_regionkey = 3 as from_end, r_regionkey in (1, 2, 3) as censored from region) s on s.study = t.study
        cross join (values (2), (3), (9)) o(outcome_id)
        left join win_joined p on p.person_id = t.subject_id and t.index_date between p.period_start and p.period_end)""",
    "cohort",
    "ev",
    "win_joined",
)
_cte(
    "win",
    """select study, target_id, subject_id, index_date, outcome_id, prior as prior_observation_days, last_outcome_date,
        case when counts then risk_start_date end as risk_start_date, case when counts then risk_end_date end as risk_end_date,
        case when counts then outcome_date end as outcome_date,
        case when counts then cast(case when censored then least(risk_end_date, outcome_date) else risk_end_date end - risk_start_date + 1 as bigint) else 0 end
            as days_at_risk, status
    from (select *, status in ('case', 'no case') as counts from (
        select *, cast(index_date - period_start as bigint) as prior,
            case when period_start is null or index_date > observed_end then 'not observed'
                when index_date - period_start < prior_days then 'short prior observation'
                when last_outcome_date is not null and (washout_days is null or index_date - last_outcome_date <= washout_days) then 'prior outcome'
                when risk_start_date > risk_end_date then 'no time at risk'
                when outcome_date is not null then 'case' else 'no case' end as status
        from (select w.*,
                (select max(c.start_date) from cohort c where c.study = w.study and c.cohort_id = w.outcome_id
                    and c.subject_id = w.subject_id and c.start_date < w.index_date) as last_outcome_date,
                (select min(c.start_date) from cohort c where c.study = w.study and c.cohort_id = w.outcome_id
                    and c.subject_id = w.subject_id and c.start_date between w.risk_start_date and w.risk_end_date) as outcome_date
            from win_timed w)))""",
    "cohort",
    "win_timed",
)

# -- documents ---------------------------------------------------------------

_cte(
    "modules",
    """select *, case when p_size <= 25 then 'SNOMED-CT' else 'HCPCS' end as system,
        case when p_size = 1 then 'REPLACE_ME' else cast(p_partkey as varchar) end as code,
        case when p_type = 'LARGE' then 'NOPE' else 'LOINC' end as lab_system,
        case when p_type = 'PROMO' then 'custom' else 'built-in:' || p_type || '/' || p_partkey || '.json' end as module
    from pv""",
    "pv",
)
_cte(
    "codes",
    """select module, 'Onset' as state, 'ConditionOnset' as state_type, system, code, p_name as display from modules
    union select module, 'Lab', 'Observation', lab_system, 'L' || t, '' from modules
    union select module, 'Lab', 'Observation', 'RxNorm', 'B' || b, p_brand from modules""",
    "modules",
)
_VOCAB_OF = """case {0} when 'SNOMED-CT' then 'SNOMED' when 'RxNorm' then 'RxNorm' when 'LOINC' then 'LOINC'
    when 'CVX' then 'CVX' when 'ICD-10-CM' then 'ICD10CM' when 'ICD-9-CM' then 'ICD9CM' when 'CPT' then 'CPT4'
    when 'HCPCS' then 'HCPCS' when 'NUBC' then 'NUBC' end"""
_cte(
    "mapped_codes",
    f"""select distinct k.system, k.code,
        coalesce(t.concept_id, case when c.standard_concept = 'S' then c.concept_id end) as concept_id
    from codes k join concept c on c.vocabulary_id = {_VOCAB_OF.format('k.system')} and c.concept_code = k.code
    left join rel r on r.concept_id_1 = c.concept_id and r.relationship_id = 'Maps to' and r.invalid_reason is null
    left join concept t on t.concept_id = r.concept_id_2
    where coalesce(t.concept_id, case when c.standard_concept = 'S' then c.concept_id end) is not null""",
    "codes",
    "concept",
    "rel",
)
_cte(
    "resolution",
    f"""select k.vocabulary_id, k.code, coalesce(max(case when c.standard_concept = 'S' or r.concept_id_2 is not null
        then 1 else 0 end), 0) as resolves
    from (select distinct {_VOCAB_OF.format('system')} as vocabulary_id, code from codes) k
    left join concept c on c.vocabulary_id = k.vocabulary_id and c.concept_code = k.code
    left join rel r on r.concept_id_1 = c.concept_id and r.relationship_id = 'Maps to' and r.invalid_reason is null
    where k.vocabulary_id is not null group by 1, 2""",
    "codes",
    "concept",
    "rel",
)
_cte(
    "items",
    """select s_suppkey as cohort_id, 0 as set_id, 1000 + s_nationkey + 1 as concept_id, true as descendants,
        false as excluded, false as mapped from supplier
    union all select s_suppkey, 0, 10000 + (s_nationkey + 1) * 10 + 1, true, true, false from supplier
        where s_nationkey % 3 = 0
    union all select s_suppkey, 1, 10000000 + s_suppkey, false, false, false from supplier
    union all select s_suppkey, 2, 999, false, false, false from supplier""",
)
_cte(
    "at_hand",
    "select distinct k.module, k.display, m.concept_id from codes k join mapped_codes m on m.system = k.system and m.code = k.code",
    "codes",
    "mapped_codes",
)
_cte(
    "reached",
    """select distinct i.cohort_id, i.set_id, i.excluded, h.concept_id from items i
    join (select distinct concept_id from at_hand) h on h.concept_id = i.concept_id
        or (i.descendants and exists (select 1 from closure k where k.a = i.concept_id and k.d = h.concept_id))""",
    "items",
    "at_hand",
    "closure",
)
_cte(
    "hits",
    """select cohort_id, set_id, concept_id from reached where not excluded
    except select cohort_id, set_id, concept_id from reached where excluded""",
    "reached",
)
_cte(
    "primaries",
    """select s_suppkey as cohort_id,
        case s_nationkey % 5 when 0 then [0] when 1 then [1, 2] when 4 then [2] else [] end as sets,
        s_nationkey % 5 = 3 as unevaluable, s_nationkey % 5 = 2 as visit_entry from supplier""",
)
_cte(
    "required",
    """select s_suppkey as cohort_id, '0.0' as requirement, 1 as set_id from supplier where s_nationkey % 4 = 1
    union all select s_suppkey, '0.0', unnest([0, 2]) from supplier where s_nationkey % 4 = 2
    union all select s_suppkey, '1.0', unnest([1, 2]) from supplier where s_nationkey % 4 = 3""",
)
_cte(
    "unmet",
    """select cohort_id, requirement, list(set_id order by set_id) as sets from required r
    group by 1, 2 having not bool_or(exists (select 1 from hits h where h.cohort_id = r.cohort_id and h.set_id = r.set_id))""",
    "required",
    "hits",
)
_cte(
    "verdicts",
    """select cohort_id,
        case when unmet is not null then 'NOT_COVERED' when entry_hit then 'COVERED'
            when visit_entry and has_requirement then 'COVERED' when visit_entry or unevaluable then 'NOT_EVALUABLE'
            else 'NOT_COVERED' end as status,
        case when unmet is not null then unmet when entry_hit or visit_entry or unevaluable then []
            else sets end as missing,
        case when unmet is not null or entry_hit or not visit_entry then ''
            when has_requirement then 'visit entry event not evaluated; its required criteria are covered'
            else 'visit-only cohort: visit types come from encounter classes, not from codes' end as note
    from (select p.*, (select u.sets from unmet u where u.cohort_id = p.cohort_id) as unmet,
            exists (select 1 from required r where r.cohort_id = p.cohort_id) as has_requirement,
            exists (select 1 from hits h where h.cohort_id = p.cohort_id and list_contains(p.sets, h.set_id)) as entry_hit
          from primaries p)""",
    "primaries",
    "unmet",
    "required",
)
_cte(
    "needed_hits",
    """select distinct h.cohort_id, h.concept_id from hits h join primaries p on p.cohort_id = h.cohort_id
    where list_contains(p.sets, h.set_id)
        or exists (select 1 from required r where r.cohort_id = h.cohort_id and r.set_id = h.set_id)""",
    "hits",
    "primaries",
    "required",
)
_cte(
    "label_rows",
    """select distinct h.cohort_id, a.module, a.display || ' [' || a.module || ']' as label
    from needed_hits h join at_hand a on a.concept_id = h.concept_id""",
    "needed_hits",
    "at_hand",
)
_cte(
    "labels",
    """select cohort_id, case when bool_and(module = 'custom') then 'custom module'
            when bool_or(module = 'custom') then 'custom + built-in' else 'built-in only' end as provided_by,
        array_to_string(list_sort(list_distinct(list(label)))[1:2], '; ') as example_codes
    from label_rows group by 1""",
    "label_rows",
)

# -- built dataset -----------------------------------------------------------

_cte(
    "built_drugs",
    """select x.person_id, c.concept_id as ingredient_concept_id, x.date as start_date,
        coalesce(x.stop_date, nullif(x.date + cast(date_diff('day', x.date, x.stop_date) as integer), x.date), x.date + 1)
            as end_date
    from mapped x join closure k on k.d = x.target_concept_id join concept c on c.concept_id = k.a
    where x.target_domain_id = 'Drug' and c.vocabulary_id = 'RxNorm' and c.concept_class_id = 'Ingredient'""",
    "mapped",
    "closure",
    "concept",
)
_islands("built_sub", "built_drugs", ["person_id", "ingredient_concept_id"], 0, "")
_islands("built_drug_eras", "built_sub", ["person_id", "ingredient_concept_id"], 30, "")
_cte(
    "built_conditions",
    """select person_id, target_concept_id, date as start_date, coalesce(stop_date, date + 1) as end_date
    from mapped where target_domain_id = 'Condition'""",
    "mapped",
)
_islands("built_condition_eras", "built_conditions", ["person_id", "target_concept_id"], 30, "")
_EMPTY = (
    "note", "note_nlp", "specimen", "fact_relationship", "dose_era", "episode", "episode_event", "metadata",
)
_DOMAIN_TABLES = {
    "Condition": "condition_occurrence",
    "Measurement": "measurement",
    "Procedure": "procedure_occurrence",
    "Drug": "drug_exposure",
    "Device": "device_exposure",
    "Observation": "observation",
}

# -- quality -----------------------------------------------------------------

_cte(
    "summary",
    """select (select count(*) from customer) + (select count(*) from orders) + (select count(*) from lineitem)
            + (select count(*) from events) as staged_rows,
        cast(4 as bigint) as staged_tables_with_rows, (select count(*) from customer) as person_rows,
        (select count(*) from orders) as visit_rows, (select count(*) from orders) as procedure_rows,
        (select count(*) from cond) as condition_rows,
        (select count(*) from cond where condition_concept_id <> 3) as mapped_condition_rows,
        (select count(*) from cond_eras_30) as condition_era_rows, (select count(*) from drug_eras_30) as drug_era_rows""",
    "cond",
    "cond_eras_30",
    "drug_eras_30",
)
_cte(
    "ages",
    """select count(*) as n_people, count(*) filter (year(born) >= 2024 - 18) as age_under_18_count,
        cast(min(year(born)) as integer) as min_year_of_birth, cast(max(year(born)) as integer) as max_year_of_birth
    from persons""",
    "persons",
)
_cte(
    "dis_summary",
    """select count(*) as visits_total, count(discharged_to_source_value) as visits_with_source,
        count(*) filter (discharged_to_source_value is not null and discharged_to_concept_id <> 0) as visits_mapped,
        count(*) filter (trim(discharged_to_source_value) = '01') as home_visits,
        count(*) filter (trim(discharged_to_source_value) <> '01') as non_home_visits from enriched""",
    "enriched",
)
_cte(
    "check_rows",
    """select 'FIELD' as check_level, 'is_required' as check_name, 'lineitem' as table_name, 'l_shipdate' as field_name,
        count(*) filter (l_shipdate is null) as n_violated, count(*) as n_rows, 0.0 as pct from lineitem
    union all select 'FIELD', 'plausible_low', 'lineitem', 'l_quantity', count(*) filter (l_quantity < 2), count(*), 5
        from lineitem
    union all select 'FIELD', 'plausible_high', 'lineitem', 'l_quantity', count(*) filter (l_quantity > 49), count(*), 1
        from lineitem
    union all select 'FIELD', 'is_required', 'drug_exposure', 'drug_exposure_end_date',
        count(*) filter (given_end is null), count(*), 10 from exposures
    union all select 'CONCEPT', 'concept_recorded', 'drug_exposure', 'drug_concept_id',
        count(*) filter (drug_concept_id = 0), count(*), 50 from exposures
    union all select 'FIELD', 'is_required', 'empty_orders', 'o_custkey', 0, 0, 0
    union all select 'TABLE', 'is_primary_key', 'lineitem', 'l_orderkey,l_linenumber',
        cast(coalesce(sum(n) filter (n > 1), 0) as bigint), cast(sum(n) as bigint), 1
        from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)
    union all select 'TABLE', 'is_primary_key', 'orders', 'o_orderkey',
        cast(coalesce(sum(n) filter (n > 1), 0) as bigint), cast(sum(n) as bigint), 0
        from (select count(*) as n from orders group by o_orderkey)
    union all select 'FIELD', 'is_foreign_key', 'lineitem', 'l_partkey', count(*) filter (l_partkey is not null
        and l_partkey not in (select p_partkey from part where p_size <= 25)), count(*), 10 from lineitem
    union all select 'FIELD', 'is_foreign_key', 'orders', 'o_custkey', count(*) filter (o_custkey is not null
        and o_custkey not in (select c_custkey from customer)), count(*), 0 from orders""",
    "exposures",
)
_cte(
    "checks",
    """select check_level, check_name, table_name, field_name, n_violated, n_rows,
        case when n_rows > 0 and n_violated * 100.0 > n_rows * pct then 1 else 0 end as failed,
        case when n_rows > 0 and n_violated * 100.0 > n_rows * pct then 0 else 1 end as passed,
        0 as is_error, case when n_rows = 0 then 1 else 0 end as not_applicable from check_rows""",
    "check_rows",
)

_EVEN = "drug_concept_id between 10000000 and 10000098 and drug_concept_id % 2 = 0"
_cte(
    "ruled",
    f"""select e.*, c.c_custkey is not null as known, c.born, c.died, c.gender,
        e.start_date between s.first and s.first + 400 or e.start_date between s.last - 300 and s.last as observed,
        k.concept_id is not null as in_vocabulary, k.domain_id, k.standard_concept, k.invalid_reason
    from exposures e left join (
        select c_custkey, {_BORN} as born, case when c_acctbal < 0 then {_DIED} end as died,
            case c_mktsegment when 'MACHINERY' then 8507 else 8532 end as gender from customer where c_custkey % 50 <> 0
    ) c on c.c_custkey = e.person_id
    left join (select o_custkey, min(cast(o_orderdate as date)) as first, max(cast(o_orderdate as date)) as last
        from orders group by 1) s on s.o_custkey = c.c_custkey
    left join concept k on k.concept_id = e.drug_concept_id""",
    "exposures",
    "concept",
)
_RULED = [
    ("FIELD", "is_required", "drug_exposure_end_date", 10, "given_end is null"),
    ("FIELD", "is_one_of", "days_supply", 50, "days_supply not between 0 and 29"),
    ("FIELD", "is_like", "drug_concept_id", 1, "drug_concept_id <> 0 and drug_concept_id not between 10000000 and 10009999"),
    ("FIELD", "plausible_low", "days_supply", 5, "days_supply < 0"),
    ("FIELD", "plausible_high", "days_supply", 5, "days_supply > 36"),
    ("FIELD", "starts_before_end", "drug_exposure_start_date", 0, "start_date > given_end"),
    ("FIELD", "is_known_person", "person_id", 5, "person_id is not null and not known"),
    ("FIELD", "plausible_after_birth", "drug_exposure_start_date", 1, "start_date < born"),
    ("FIELD", "plausible_before_death", "drug_exposure_start_date", 1, "start_date > died + 30"),
    ("FIELD", "within_observation", "drug_exposure_start_date", 50, "start_date is not null and not coalesce(observed, false)"),
    ("CONCEPT", "concept_recorded", "drug_concept_id", 20, "drug_concept_id = 0"),
    ("CONCEPT", "concept_exists", "drug_concept_id", 0, "drug_concept_id <> 0 and not in_vocabulary"),
    ("CONCEPT", "concept_is_standard", "drug_concept_id", 5,
        "drug_concept_id <> 0 and not (coalesce(standard_concept, '') = 'S' and invalid_reason is null)"),
    ("CONCEPT", "concept_in_domain", "drug_concept_id", 50, "drug_concept_id <> 0 and domain_id <> 'Drug'"),
    ("CONCEPT", "plausible_gender", "drug_concept_id", 0.5, f"{_EVEN} and coalesce(gender, 0) <> 8532"),
    ("CONCEPT", "plausible_value", "drug_concept_id", 0.5, f"{_EVEN} and days_supply not between 0 and 20"),
    ("FIELD", "fits_width", "sig", 0, None),
    ("CONCEPT", "plausible_unit", "drug_concept_id", 0, None),
]


def _count_of(*tables: str) -> str:
    return " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in tables)


_SEARCH = """concept_id, concept_name, domain_id, vocabulary_id, concept_class_id, standard_concept, concept_code"""


def _search(term: str, domain: str | None = None) -> str:
    where = "standard_concept = 'S' and invalid_reason is null" + (f" and domain_id = '{domain}'" if domain else "")
    t = term.lower()
    _cte(
        f"direct_{t.replace(' ', '_').replace('#', '')}",
        f"""select {_SEARCH} from concept where {where} and contains(lower(concept_name), '{t}')
        order by case when lower(concept_name) = '{t}' then 0 else 1 end, length(concept_name), concept_name, concept_id
        limit 20""",
        "concept",
    )
    direct = f"direct_{t.replace(' ', '_').replace('#', '')}"
    return _sql(
        f"""select * from {direct} union select {_SEARCH} from (
            select c.* from concept c join syn s on s.concept_id = c.concept_id
            where {where} and contains(lower(concept_synonym_name), '{t}')
            order by length(concept_synonym_name), concept_name, c.concept_id limit 10)
        where (select count(*) from {direct}) < 3""",
        direct,
        "syn",
    )


_cte(
    "batch_terms",
    """select distinct scope || ':' || split_part(concept_name, ' ', 1) as term_id, lower(split_part(concept_name, ' ', 1)) as low,
        case when scope = 'drugs' then 'Drug' end as dom from concept, (select unnest(['all', 'drugs']) as scope)""",
    "concept",
)
_cte(
    "batch_direct",
    f"""select term_id, {_SEARCH}, 0 as kind, row_number() over (partition by term_id order by
            case when lower(concept_name) = low then 0 else 1 end, length(concept_name), concept_name, concept_id) as place
        from concept, batch_terms where standard_concept = 'S' and invalid_reason is null
        and contains(lower(concept_name), low) and (dom is null or dom = domain_id) qualify place <= 20""",
    "concept",
    "batch_terms",
)
_cte(
    "batch_more",
    f"""select term_id, c.concept_id, {_SEARCH.replace("concept_id,", "", 1)}, 1 as kind, row_number() over (partition by term_id
            order by length(concept_synonym_name), concept_name, c.concept_id) as place
        from concept c join syn s on s.concept_id = c.concept_id, batch_terms
        where standard_concept = 'S' and invalid_reason is null and contains(lower(concept_synonym_name), low)
        and (dom is null or dom = domain_id)
        and term_id not in (select term_id from batch_direct group by 1 having count(*) >= 3) qualify place <= 10""",
    "concept",
    "syn",
    "batch_terms",
    "batch_direct",
)


_EDGE_ROWS = "select l_orderkey, l_partkey, l_discount, l_returnflag, o_orderstatus, o_orderpriority from lineitem join orders on l_orderkey = o_orderkey"
_TOTALS = "select l_orderkey, cast(sum(cast(l_discount as decimal(18, 2))) as double) as total from lineitem group by 1"


def all_sql() -> dict[str, str]:
    """One statement per query that SQL can express over whole tables."""
    out = {
        "staging_scan": """select cast(c_custkey as varchar) as c_custkey,
            case when c_acctbal >= 0 then c_name || ', "' || c_mktsegment || '"' end as c_name,
            case when c_mktsegment <> 'BUILDING' then c_mktsegment end as c_mktsegment from customer""",
        "staging_folder": _count_of("customer", "orders", "part"),
        "vocabulary_scan": _sql(
            """select concept_id, case when concept_class_id = 'Ingredient' then '' else concept_name end as concept_name,
            domain_id, standard_concept, '"' || concept_code as concept_code,
            case when domain_id = 'Drug' then null else date '1970-01-01' end as valid_start_date, invalid_reason
            from concept""",
            "concept",
        ),
        "rejected_rows": _sql(
            """select 'customer' as table_name, c_custkey || ',"' || c_name || '"' as line, '2 fields for 3 columns' as reason
                from customer where c_acctbal < 0
            union all select 'customer', c_custkey || ',"' || c_name || '",BUILDING,"more, of it"', '4 fields for 3 columns'
                from customer where c_acctbal >= 0 and c_mktsegment = 'BUILDING'
            union all select 'concept', cast(concept_id as varchar), '1 fields for 3 columns' from concept where domain_id = 'Drug'""",
            "concept",
        ),
        "quarantined_staging": """select cast(c_custkey as varchar) as id, c_name as name, c_mktsegment as segment from customer
            where c_acctbal >= 0 and c_mktsegment <> 'BUILDING'""",
        "quarantined_vocabulary": _sql(
            "select concept_id, concept_name, domain_id from concept where domain_id <> 'Drug'", "concept"
        ),
        "accepted_gate": _sql(
            """select metric, value, cast(80 as double) as threshold, case when value >= 80 then 'PASS' else 'FAIL' end as status from (
                select 'accepted_pct of customer' as metric, cast(100 as double)
                    * count(*) filter (c_acctbal >= 0 and c_mktsegment <> 'BUILDING') / count(*) as value from customer
                union all select 'accepted_pct of concept', cast(100 as double) * count(*) filter (domain_id <> 'Drug') / count(*)
                from concept)""",
            "concept",
        ),
        "load_missing_tables": _sql(
            """select 'concept' as table_name, count(*) as row_count from concept
            union all select 'concept_ancestor', count(*) from closure
            union all select 'concept_relationship', count(*) from rel""",
            "concept",
            "closure",
            "rel",
        ),
        "resumable_load": " union all ".join(
            f"select '{t}' as table_name, cast(1 as bigint) as n_loads, count(*) as loaded_rows from {t}"
            for t in ("customer", "supplier", "orders")
        ),
        "header_only_staging": "select 'customer' as table_name, cast(c_custkey as varchar) as id, c_name as name from customer",
        "layout_probe": "select 'second' as table_name, count(*) as row_count from supplier",
        "copied_vocabulary": _sql(
            """select 'concept' as table_name, count(*) as row_count from concept
            union all select 'concept_ancestor', count(*) from closure
            union all select 'concept_synonym', count(*) from syn""",
            "concept",
            "closure",
            "syn",
        ),
        "shared_vocabulary": _sql("select domain_id, count(*) as n_concepts from concept group by 1", "concept"),
        "stamped_map_build": _sql(
            """select (select 'v5.0 ' || r_name from region where r_regionkey = 0) as vocab_version, 2 as builder_version,
            (select count(*) from std_map) as source_to_standard_vocab_map_rows,
            (select count(*) from src_map) as source_to_source_vocab_map_rows, 2 as n_builds""",
            "std_map",
            "src_map",
        ),
        "table_probe": """select 'concept' as table_name, true as present, count(*) > 0 as has_rows, '' as missing_columns
            from part
            union all select 'concept_ancestor', true, false, ''
            union all select 'concept_relationship', false, false, 'concept_id_1,concept_id_2'
            union all select 'person', true, count(*) > 0, 'run_name' from customer""",
        "picked_dataset": "select 'study_9' as table_name, count(*) as row_count from supplier",
        "csv_report_sink": _count_of("orders", "lineitem", "events"),
        "streamed_staging": """select cast(event_id as varchar) as event_id,
            case when event_type <> 'error' then event_type end as event_type, props from events""",
        "tolerant_dates": _sql("select person_source_value as id, born as birthdate from persons", "persons"),
        "death_dates": _sql("select person_source_value as id, died as death_date from persons", "persons"),
        "compact_dates": """select o_orderkey, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end
            as order_date from orders""",
        "discharge_code_repair": _sql(
            """select encounter_id, case when length(trim(discharge)) = 1 then '0' || trim(discharge)
            else nullif(trim(discharge), '') end as discharge from ev_enc""",
            "ev_enc",
        ),
        "tolerant_numbers": _sql(
            "select try_cast(value as double) as number, left(units, 50) as units, count(*) as n from coded group by 1, 2",
            "coded",
        ),
        "visit_class_concepts": _sql(
            f"""select encounterclass, {_VISIT_CONCEPT} as visit_concept_id, {_GROUP.format('encounterclass')} as class_group,
            count(*) as n from ord_enc group by 1, 2, 3""",
            "ord_enc",
        ),
        "visit_match_priority": _sql(
            f"select encounterclass, visit_type, {_PRIORITY} as priority, count(*) as n from ev_assign group by 1, 2, 3",
            "ev_assign",
        ),
        "run_filter": """select 'events' as table_name, count(*) filter (event_type = 'purchase') as row_count from events
            union all select 'orders', count(*) from orders""",
        "source_prefix_filter": """select c_custkey as person_id, 'csv:' || c_name as person_source_value from customer
            where c_acctbal >= 0""",
        "valid_standard_concepts": _sql(
            """select domain_id, vocabulary_id, count(*) as n_concepts from concept
            where standard_concept = 'S' and invalid_reason is null group by 1, 2""",
            "concept",
        ),
        "identifier_slug": """select p_partkey, regexp_replace(lower(p_name || ' -- ' || p_brand || ' -- ' || p_type),
            '[^a-z0-9]+', '_', 'g') as slug from part""",
        "ingredient_map": _sql("select * from ing_map", "ing_map"),
        "imputed_exposures": _sql(
            "select person_id, ingredient_concept_id, start_date, end_date, count(*) as n from ing_exp group by all",
            "ing_exp",
        ),
        "sub_exposures": _sql("select * from sub_days", "sub_days"),
        "drug_era": _sql(
            f"""select row_number() over (order by person_id, ingredient_concept_id, start_date, end_date) as drug_era_id,
            {_ERA} from drug_eras_30""",
            "drug_eras_30",
        ),
        "drug_era_gap_180": _sql(f"select {_ERA} from drug_eras_180", "drug_eras_180"),
        "condition_era": _sql(
            f"""select row_number() over (order by person_id, condition_concept_id, start_date, end_date)
            as condition_era_id, {_COND_ERA} from cond_eras_1""",
            "cond_eras_1",
        ),
        "condition_era_gap_30": _sql(f"select {_COND_ERA} from cond_eras_30", "cond_eras_30"),
        "surrogate_ids": """select row_number() over (order by o_custkey, o_orderdate, o_orderkey) as order_number,
            o_custkey, o_orderdate, o_orderkey from orders""",
        "all_visits": _sql("select * from ev_visits", "ev_visits"),
        "lasting_visit_ids": _sql(
            """select coalesce(f.visit_occurrence_id, (select max(visit_occurrence_id) from early_visits)
                + row_number() over (partition by f.visit_occurrence_id is null order by v.patient, v.encounterclass, v.visit_start_date))
                as visit_occurrence_id, v.patient, v.encounterclass, v.visit_start_date, f.visit_occurrence_id as given_before
            from ev_visits v left join early_visits f on f.patient = v.patient and f.encounterclass = v.encounterclass
                and f.visit_start_date = v.visit_start_date""",
            "early_visits",
            "ev_visits",
        ),
        "assign_all_visit_ids": _sql("select * from ev_assign", "ev_assign"),
        "final_visit_ids": _sql("select * from ev_final", "ev_final"),
        "resolved_visits": _sql("select * from ev_final", "ev_final"),
        "selected_visits": _sql(
            "select * from ev_visits where visit_occurrence_id in (select visit_occurrence_id_new from ev_final)",
            "ev_visits",
            "ev_final",
        ),
        "visit_occurrence": _sql("select * from ord_occurrence", "ord_occurrence"),
        "visit_detail": _sql(
            """select visit_occurrence_id + 1000000 as visit_detail_id, person_id,
            visit_concept_id as visit_detail_concept_id, visit_start_date as visit_detail_start_date,
            visit_end_date as visit_detail_end_date, visit_type_concept_id as visit_detail_type_concept_id,
            visit_source_value as visit_detail_source_value, visit_occurrence_id from ord_occurrence""",
            "ord_occurrence",
        ),
        "discharge_per_visit": _sql("select * from discharged", "discharged"),
        "discharge_enrichment": _sql("select * from enriched", "enriched"),
        "source_to_standard_map": _sql("select * from std_map", "std_map"),
        "source_to_source_map": _sql("select * from src_map", "src_map"),
        "states_map": """select n_name as state, 'N' || n_nationkey as state_abbreviation,
            cast(case when n_regionkey = 2 then 0 else 920000 + n_nationkey end as bigint) as state_concept_id
            from nation""",
        "vocabulary_release": "select 'v5.0 ' || r_name as vocabulary_version from region where r_regionkey = 0",
        "concept_search": _search("bolt"),
        "concept_search_batch": _sql(
            f"""select term_id, row_number() over (partition by term_id order by least_place) as position, {_SEARCH} from (
                select term_id, {_SEARCH}, min(kind * 1000 + place) as least_place
                from (select * from batch_direct union all select * from batch_more) group by all)""",
            "batch_direct",
            "batch_more",
        ),
        "concept_search_in_domain": _search("brand#1", "Drug"),
        "concept_search_synonyms": _search("syn economy"),
        "top_descendants": _sql(
            """select ancestor_concept_id, concept_id, concept_name, domain_id, vocabulary_id, levels_below from (
            select k.a as ancestor_concept_id, c.concept_id, c.concept_name, c.domain_id, c.vocabulary_id,
                k.n as levels_below, row_number() over (partition by k.a order by k.n, c.concept_name, c.concept_id) as rn
            from closure k join concept c on c.concept_id = k.d join concept g on g.concept_id = k.a
            where g.concept_class_id = 'Ingredient' and k.n > 0 and c.standard_concept = 'S' and c.invalid_reason is null)
            where rn <= 10""",
            "closure",
            "concept",
        ),
        "code_mapping": _sql("select * from mapped_codes", "mapped_codes"),
        "code_resolution": _sql("select * from resolution", "resolution"),
        "unresolved_codes": _sql(
            f"""select distinct r.vocabulary_id, r.code, k.state from resolution r
            join codes k on k.code = r.code and {_VOCAB_OF.format('k.system')} = r.vocabulary_id where r.resolves = 0""",
            "resolution",
            "codes",
        ),
        "unknown_code_systems": _sql(
            f"select distinct system from codes where {_VOCAB_OF.format('system')} is null", "codes"
        ),
        "placeholder_codes": _sql(
            "select system, count(*) as n from codes where code = 'REPLACE_ME' group by 1", "codes"
        ),
        "hierarchy_closure": """with recursive edge as (
                select cast(n_regionkey as bigint) as parent, cast(1000 + n_nationkey as bigint) as child from nation
                union all select cast(1000 + c_nationkey as bigint), 1000000 + c_custkey from customer),
            path as (
                select node as ancestor, node as descendant, 0 as level from (select parent as node from edge union select child from edge)
                union all select p.ancestor, e.child, p.level + 1 from path p join edge e on e.parent = p.descendant)
            select ancestor as ancestor_concept_id, descendant as descendant_concept_id,
                min(level) as min_levels_of_separation, max(level) as max_levels_of_separation from path group by 1, 2""",
        "concept_set_hits": _sql("select * from hits", "hits"),
        "observation": _domain(
            "observation",
            "Observation",
            """date as observation_date, cast(date as timestamp) as observation_datetime,
            try_cast(value as double) as value_as_number, cast(null as varchar) as value_as_string,
            0 as value_as_concept_id, 0 as qualifier_concept_id, 0 as unit_concept_id, left(units, 50) as unit_source_value,
            cast(null as varchar) as qualifier_source_value, left(value, 50) as value_source_value,
            cast(null as bigint) as observation_event_id, cast(null as integer) as obs_event_field_concept_id""",
            38000280,
        ),
        "measurement": _domain(
            "measurement",
            "Measurement",
            """date as measurement_date, try_cast(value as double) as value_as_number, 0 as value_as_concept_id,
            0 as unit_concept_id, left(units, 50) as unit_source_value, left(value, 50) as value_source_value""",
        ),
        "condition_occurrence": _domain(
            "condition", "Condition", "date as condition_start_date, stop_date as condition_end_date"
        ),
        "procedure_occurrence": _domain(
            "procedure", "Procedure", "date as procedure_date, cast(null as integer) as quantity"
        ),
        "drug_exposure": _domain(
            "drug",
            "Drug",
            """date as drug_exposure_start_date, stop_date as drug_exposure_end_date,
            cast(date_diff('day', date, stop_date) as integer) as days_supply""",
        ),
        "device_exposure": _domain(
            "device", "Device", "date as device_exposure_start_date, stop_date as device_exposure_end_date"
        ),
        "person": _sql(
            """select p.person_id, case upper(gender) when 'M' then 8507 when 'F' then 8532 else 0 end as gender_concept_id,
            cast(year(born) as integer) as year_of_birth, cast(month(born) as integer) as month_of_birth,
            cast(day(born) as integer) as day_of_birth, 0 as race_concept_id, 0 as ethnicity_concept_id,
            l.location_id, person_source_value, gender as gender_source_value
            from persons p left join locations l on l.state = 'N' || p.c_nationkey""",
            "persons",
            "locations",
        ),
        "location": _sql("select * from locations", "locations"),
        "care_site": """select row_number() over (order by care_site_name, place_of_service_source_value) as care_site_id, *,
            0 as place_of_service_concept_id from (select distinct c_mktsegment as care_site_name,
            c_nationkey as place_of_service_source_value from customer)""",
        "provider": _sql("select *, 0 as specialty_concept_id from providers", "providers"),
        "observation_period": _sql(
            """select row_number() over (order by person_id) as observation_period_id, *, 32882 as period_type_concept_id
            from (select min(start_date) as observation_period_start_date, max(stop_date) as observation_period_end_date,
                  person_id from ord_enc join persons on person_source_value = patient group by person_id)""",
            "ord_enc",
            "persons",
        ),
        "payer_plan_period": _sql("select * from plans", "plans"),
        "claim_costs": _sql("select * from costs", "costs"),
        "cost": _sql(
            """select row_number() over (order by target_domain_id, event_id, claim_id) as cost_id,
            event_id as cost_event_id, claim_id, target_domain_id as cost_domain_id, 32814 as cost_type_concept_id,
            total_charge, total_paid, payer_plan_period_id
            from billed b join costs c on c.encounter_id = b.encounter and c.person_id = b.person_id""",
            "billed",
            "costs",
        ),
        "cdm_source": """select 'driver tables' as cdm_source_name, 'DT' as cdm_source_abbreviation, 'nobody' as cdm_holder,
            date '2024-01-01' as cdm_release_date, 'v5.4' as cdm_version, 'v5.0 ' || r_name as vocabulary_version
            from region where r_regionkey = 0""",
        "cohort_instantiation": _sql(f"select {_COHORT_ROW} from instantiated", "instantiated"),
        "cohort_to_period_end": _sql(f"select {_COHORT_ROW} from instantiated_open", "instantiated_open"),
        "refused_amounts": """select case l_returnflag when 'R' then 'PAYMENT' when 'A' then 'CHARGE' else 'TRANSFER' end as transfer_type,
            count(*) filter (l_extendedprice > 100000) as refused_amounts from lineitem group by 1""",
        "cohort_windows": _sql("select * from win", "win"),
        "cohort_incidence": _sql(
            """select study, target_id, outcome_id, count(*) as index_dates,
                count(*) filter (status in ('not observed', 'short prior observation')) as without_history,
                count(*) filter (status = 'prior outcome') as washed_out, count(*) filter (status = 'no time at risk') as without_time,
                count(*) filter (status = 'case') as cases, cast(sum(days_at_risk) as bigint) as days_at_risk from win group by 1, 2, 3""",
            "win",
        ),
        "cohort_era_collapse": _sql(f"select {_COHORT_ROW} from cohort_eras", "cohort_eras"),
        "cohort_subjects": _sql(
            "select study, cohort_id, count(distinct subject_id) as subjects from cohort group by 1, 2", "cohort"
        ),
        "cohort_overlap": _sql(
            """select o.study, o.cohort_id, count(distinct o.subject_id) as subjects_in_target
            from cohort o join manifest m on m.study = o.study and m.cohort_id = o.cohort_id and m.is_outcome
            join studies s on s.study = o.study
            join cohort t on t.study = o.study and t.subject_id = o.subject_id and t.cohort_id = s.target_id group by 1, 2""",
            "cohort",
            "manifest",
            "studies",
        ),
        "cohort_thresholds": _sql("select * exclude (target_id) from judged", "judged"),
        "cohort_qc": _sql("select * exclude (target_id) from judged where target_id is not null", "judged"),
        "study_problems": _sql(
            """select study, 'no target or no outcome cohort' as problem from studies s where target_id is null
            or not exists (select 1 from manifest m where m.study = s.study and m.is_outcome)
            union all select study, 'target cohort not in the manifest: ' || target_id from studies s
            where target_id is not null and not exists (
                select 1 from manifest m where m.study = s.study and m.cohort_id = s.target_id)""",
            "studies",
            "manifest",
        ),
        "membership_difference": _sql(
            """select person_id, start_date, 'right' as missing_from from (
                select person_id, start_date from ev where concept = 'purchase'
                except select person_id, start_date from ev where concept = 'error')
            union all select person_id, start_date, 'left' from (
                select person_id, start_date from ev where concept = 'error'
                except select person_id, start_date from ev where concept = 'purchase')""",
            "ev",
        ),
        "emitted_codes": _sql("select * from codes", "codes"),
        "concept_set_items": _sql("select * from items", "items"),
        "primary_criteria": _sql(
            "select cohort_id, array_to_string(sets, ',') as primary_sets, unevaluable, visit_entry from primaries",
            "primaries",
        ),
        "required_sets": _sql("select * from required", "required"),
        "cohort_verdicts": _sql(
            "select cohort_id, status, array_to_string(missing, ',') as missing_sets, note from verdicts", "verdicts"
        ),
        "coverage_report": _sql(
            """select v.cohort_id,
            case when s_acctbal < 0 and status = 'NOT_COVERED' then 'EXPECTED_EMPTY' else status end as status,
            concat_ws('; ', case when len(missing) > 0 then 'no module code reaches concept set(s) '
                    || array_to_string(missing, ', ') else nullif(note, '') end,
                case when s_acctbal < 0 then case when status = 'COVERED'
                    then 'declared expected_empty but the module can emit it' else 'expected empty' end end) as detail,
            coalesce(provided_by, '') as provided_by, coalesce(example_codes, '') as example_codes
            from verdicts v join supplier on s_suppkey = v.cohort_id left join labels l on l.cohort_id = v.cohort_id""",
            "verdicts",
            "labels",
        ),
        "table_row_counts": _count_of(
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"
        ),
        "dataset_summary": _sql("select * from summary", "summary"),
        "summary_document": _sql("select * from ages", "ages"),
        "threshold_gate": _sql(
            """select 'person_rows' as metric, cast(person_rows as double) as value, cast(100 as double) as threshold,
            case when person_rows >= 100 then 'PASS' else 'FAIL' end as status from summary
            union all select 'mapped_condition_pct', 100.0::double * mapped_condition_rows / condition_rows,
            cast(90 as double), case when 100.0 * mapped_condition_rows / condition_rows >= 90 then 'PASS' else 'FAIL' end
            from summary""",
            "summary",
        ),
        "stage_failures": "select 'summary' as stage, 'person_rows is below its threshold' as message from (select count(*) as n from customer) where n < 1000000000",
        "age_profile": _sql("select * from ages", "ages"),
        "discharge_summary": _sql("select * from dis_summary", "dis_summary"),
        "discharge_verdict": _sql(
            """select check_name, value, threshold, case when value >= threshold then 'PASS' else 'FAIL' end as status from (
            select 'discharge_dispositions_present' as check_name, cast(visits_with_source as double) as value,
                cast(1 as double) as threshold from dis_summary
            union all select 'discharge_codes_mapped_pct', round(case when visits_with_source > 0
                then 100.0::double * visits_mapped / visits_with_source else 0 end, 1), 90 from dis_summary
            union all select 'home_discharge_present', home_visits, 1 from dis_summary
            union all select 'non_home_discharge_present', non_home_visits, 1 from dis_summary)""",
            "dis_summary",
        ),
        "column_profile": """select 'documents' as table_name, column_name, max_length, declared_width,
            case when max_length > declared_width
                then greatest(64, cast(power(2, length(bin(max_length))) as bigint)) else declared_width end as suggested_width,
            max_length > declared_width as must_widen
            from (select 'text' as column_name, coalesce(max(length(text)), 0) as max_length, cast(8000 as bigint) as declared_width from documents
            union all select 'lang', coalesce(max(length(lang)), 0), 2 from documents
            union all select 'source', coalesce(max(length(source)), 0), 4 from documents)""",
        "field_profile": _sql(
            " union all ".join(
                f"""select 'condition_occurrence' as table_name, '{name}' as column_name, count(*) as n_rows,
                count(*) filter ({col} is null) as n_null, count(distinct {col}) as n_distinct from cond"""
                for name, col in (
                    ("person_id", "person_id"),
                    ("condition_concept_id", "condition_concept_id"),
                    ("condition_start_date", "start_date"),
                    ("condition_end_date", "given_end"),
                )
            ),
            "cond",
        ),
        "sketched_profile": " union all ".join(
            f"""select 'lineitem' as table_name, '{name}' as column_name, count(*) as n_rows,
            count(*) - count({name}) as n_null, count(distinct {name}) as n_distinct,
            true as counts_agree, true as distinct_within from lineitem"""
            for name in (
                "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                "l_tax", "l_returnflag", "l_linestatus",
            )
        ),
        "frequent_values": " union all ".join(
            f"""select 'lineitem' as table_name, '{name}' as column_name, cast({name} as varchar) as value,
            count(*) as n_rows from lineitem where {name} is not null group by {name}"""
            for name in ("l_returnflag", "l_linestatus", "l_linenumber")
        ),
        "dataset_difference": """select o_orderkey, case o_orderkey % 1000 when 1 then 'left' else 'changed' end as difference,
            cast(1 as bigint) as n_left, cast(o_orderkey % 1000 > 1 as bigint) as n_right,
            case o_orderkey % 1000 when 1 then '' when 2 then 'o_custkey,o_orderstatus' else 'o_orderstatus' end as changed_columns
            from orders where o_orderkey % 1000 in (1, 2, 3)
            union all select -o_orderkey, 'right', 0, 1, '' from orders where o_orderkey % 1000 = 7""",
        "concept_counts": _sql(
            """select condition_concept_id as concept_id, count(*) as n_rows, count(distinct person_id) as n_persons
            from cond group by 1""",
            "cond",
        ),
        "month_counts": _sql(
            "select cast(date_trunc('month', start_date) as date) as month, count(*) as n_rows from exposures group by 1",
            "exposures",
        ),
        "quality_checks": _sql("select * from checks", "checks"),
        "clinical_rules": _sql(
            """select check_level, check_name, table_name, field_name, n_violated, n_rows,
            case when n_violated * 100.0 > n_rows * pct then 1 else 0 end as failed,
            case when n_violated * 100.0 <= n_rows * pct then 1 else 0 end as passed,
            case when n_violated is null then 1 else 0 end as is_error, 0 as not_applicable from ("""
            + " union all ".join(
                f"""select '{level}' as check_level, '{check}' as check_name, 'drug_exposure' as table_name,
                '{field}' as field_name, {f"count(*) filter ({violated})" if violated else "cast(null as bigint)"} as n_violated,
                count(*) as n_rows, {pct} as pct from ruled"""
                for level, check, field, pct, violated in _RULED
            )
            + """ union all select check_level, check_name, table_name, field_name, n_violated, n_rows, pct from check_rows
                where table_name = 'lineitem' and check_level = 'TABLE')""",
            "ruled", "check_rows",
        ),
        "quality_check_summary": _sql(
            """select count(*) filter (failed = 1) as failed_checks, count(*) filter (passed = 1) as passed_checks,
            count(*) filter (is_error = 1) as error_checks, count(*) filter (not_applicable = 1) as not_applicable_checks,
            count(*) as total_checks from checks""",
            "checks",
        ),
        "top_warnings": """select o_custkey, count(*) as n_lines from lineitem join orders on l_orderkey = o_orderkey
            group by 1 order by n_lines, o_custkey limit 50""",
        "edges_missing_target": """select distinct l_orderkey as src, l_partkey as dst from lineitem
            where l_partkey not in (select p_partkey from part where p_size <= 25)""",
        "nodes_without_inbound": """select o_orderkey as name from orders where o_orderkey <> 0
            and o_orderkey not in (select l_orderkey from lineitem)""",
        "unbalanced_weights": f"""select src, round(sum(weight), 6) as weight_sum from (
            select r.l_orderkey as src, case when o_orderpriority = '1-URGENT' and total > 0 then l_discount / total
                when o_orderpriority = '5-LOW' and l_returnflag = 'R' then null else l_discount end as weight
            from ({_EDGE_ROWS}) r join ({_TOTALS}) t on t.l_orderkey = r.l_orderkey)
            group by 1 having count(*) filter (weight is null) = 0 and abs(sum(weight) - 1) > 1e-6""",
        "graph_problems": f"""select distinct o_orderstatus, 'missing target' as problem, 'p' || l_partkey as node, l_orderkey
                from ({_EDGE_ROWS}) where l_returnflag = 'R'
            union all select o_orderstatus, 'no inbound edge', 'o' || o_orderkey, null from orders
                where o_orderkey <> 0 and o_orderkey not in (select l_orderkey from lineitem)
            union all select o_orderstatus, 'weights do not sum to 1', 'o' || l_orderkey, null from ({_EDGE_ROWS})
                where l_returnflag = 'R' group by o_orderstatus, l_orderkey having abs(sum(l_discount) - 1) > 1e-6""",
    }
    for gap in (0, 1, 2):
        out[f"event_eras_gap_{gap}"] = _sql(f"select * from eras_{gap}", f"eras_{gap}")
    out["graph_problems"] = f"select o_orderstatus, problem, node from ({out['graph_problems']})"
    deaths = """select p.person_id, {day} as death_date, cast({day} as timestamp) as death_datetime,
        32817 as death_type_concept_id, cast({cause} as bigint) as cause_concept_id,
        {source} as cause_source_value, 0 as cause_source_concept_id"""
    recovered = (
        deaths.format(day="p.died", cause="0", source="cast(null as varchar)")
        + """ from persons p where p.died is not null and not exists (
            select 1 from ord_enc e where e.patient = p.person_source_value and e.code = '308646001')"""
    )
    out["recovered_deaths"] = _sql(recovered, "persons", "ord_enc")
    out["death"] = _sql(
        deaths.format(
            day="e.start_date",
            cause="""coalesce((select min(m.target_concept_id) from std_map m where m.source_code = e.reasoncode
                and m.target_domain_id = 'Condition' and m.target_vocabulary_id = 'SNOMED'
                and m.target_standard_concept = 'S' and m.target_invalid_reason is null), 0)""",
            source="e.reasoncode",
        )
        + " from ord_enc e join persons p on p.person_source_value = e.patient where e.code = '308646001' union all "
        + recovered,
        "persons",
        "ord_enc",
        "std_map",
    )
    every = {
        "person": "persons",
        "location": "locations",
        "care_site": "nation",
        "provider": "providers",
        "observation_period": "(select distinct patient from ord_enc join persons on person_source_value = patient)",
        "visit_occurrence": "ord_occurrence",
        "visit_detail": "ord_occurrence",
        "condition_era": "built_condition_eras",
        "drug_era": "built_drug_eras",
        "cdm_source": "region where r_regionkey = 0",
        "death": f"({out['death']})",
        "payer_plan_period": "plans",
        "cost": "billed b join costs c on c.encounter_id = b.encounter and c.person_id = b.person_id",
    } | {table: f"mapped where target_domain_id = '{domain}'" for domain, table in _DOMAIN_TABLES.items()}
    out["built_dataset"] = _sql(
        " union all ".join(
            [f"select '{table}' as table_name, count(*) as row_count from {rows}" for table, rows in every.items()]
            + [f"select '{table}', cast(0 as bigint)" for table in _EMPTY]
        ),
        "persons", "locations", "providers", "ord_enc", "ord_occurrence", "built_condition_eras", "built_drug_eras",
        "plans", "billed", "costs", "mapped",
    )
    out["ensured_tables"] = " union all ".join(
        ["select 'person' as table_name, count(*) as row_count from customer"]
        + [f"select '{table}', cast(0 as bigint)" for table in (*every, *_EMPTY) if table != "person"]
    )
    return out
