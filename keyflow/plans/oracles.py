"""DuckDB oracle SQL per registered query (same column names and types)."""

from __future__ import annotations

_EVENTS_LOG = ("(select *, least(greatest(cast(floor(value/20) as bigint),0),3) f, "
               "event_type<>'signup' valid from events) x")
_COUNTERS = (
    "select cast(sum(case when valid and f<3 then 1 else 0 end) as bigint) sent, "
    "cast(sum(case when valid and f=3 then 1 else 0 end) as bigint) failed, "
    "cast(sum(case when valid then f else 0 end) as bigint) retries, "
    "cast(sum(case when valid and f>=1 then 1 else 0 end) as bigint) retried, "
    "cast(sum(case when not valid then 1 else 0 end) as bigint) invalid "
    f"from {_EVENTS_LOG}"
)
_LATENCY = "cast(1706745600000-epoch_us(ts)//1000 as double)"
_ROLLUP = ("select n_name label, count(*) cnt from customer join nation "
           "on c_nationkey=n_nationkey group by 1")

_LATEST = ("select user_id id, arg_max(event_type,(ts,event_id)) event_type, "
                      "arg_max(value,(ts,event_id)) value from events group by 1")

_CLAIM = ("select id, c_name username, n_name gender from (select o_orderkey id, o_custkey "
          "from orders where o_orderstatus='O' {} order by o_orderdate, o_orderkey limit 500) o "
          "left join customer on o_custkey=c_custkey left join nation on c_nationkey=n_nationkey")

_COPIES = ("with a as (select o_orderkey k, o_totalprice v from orders), "
           "c as (select k, case when k//100%31=7 and k%5=0 then v+1 else v end v from a "
           "where not (k//100%31=7 and k%7=0)), "
           "b as (select * from c union all select -k-1, v from a where k//100%31=7 and k%11=0 "
           "union all select * from c where k//100%31=7 and k%13=0), "
           "x as (select k, list(v order by v) v from a group by k), "
           "y as (select k, list(v order by v) v from b group by k), "
           "d as (select coalesce(x.k,y.k) k, x.k is not null l, y.k is not null r "
           "from x full join y on x.k=y.k where x.v is distinct from y.v), "
           "m as (select min(k) low, greatest(1,(max(k)-min(k)+1+255)//256) w from a) ")
_OFFSETS = ("with p as (select user_id%6 part, event_id o, case when event_id%11=4 then 2 else 1 end n "
            "from events where event_id%10<>3), "
            "c as (select user_id%6 part, event_id o, 1+case when event_id%5=0 then 1 else 0 end"
            "+case when event_id%55=15 then 1 else 0 end n from events where event_id%7<>2), "
            "j as (select coalesce(p.part,c.part) part, coalesce(p.o,c.o) o, p.n np, c.n nc "
            "from p full join c on p.o=c.o and p.part=c.part) ")

ORACLE_SQL: dict[str, str] = {
    "api_flatten": "select conv_id, cast(turn as bigint) turn, role, text from conversations",
    "batch_metrics": ("select count(*) \"rows\", count(ts) measured, "
                      f"max({_LATENCY}) p_max from events"),
    "count_all": "select count(*) cnt from customer",
    "count_footer": "select count(*) cnt from customer",
    "count_by_dim": ("select n_name label, count(*) cnt from customer join "
                     "(select * from nation where n_regionkey<>0) n on c_nationkey=n_nationkey "
                     "group by 1"),
    "count_by_flat": ("select case when c_mktsegment<>'BUILDING' then c_mktsegment end seg, "
                      "count(*) cnt from customer group by 1"),
    "count_filtered_dim": ("select count(*) cnt from customer join nation "
                           "on c_nationkey=n_nationkey where n_regionkey=1"),
    "count_filtered_flat": "select count(*) cnt from customer where c_mktsegment='BUILDING'",
    "delivery_counters": _COUNTERS,
    "delivery_expected": ("select p, 1-p*p*p success, 1-p*p recovery, 1+p+p*p retries "
                          "from (select cast(n_nationkey as double)/25 p from nation) x"),
    "delivery_ratios": ("select sent+failed total, "
                        "100*cast(sent as double)/(sent+failed) success_pct, "
                        "100*cast(retried-failed as double)/retried recovery_pct, "
                        "cast(retries as double)/retried avg_retries "
                        f"from ({_COUNTERS}) y"),
    "diff_ranges": (_COPIES + "select distinct case when k<low then 0 "
                    "else least((k-low)//w,255) end \"range\" from d, m"),
    "dim_seed": ("select distinct c_mktsegment code, case when c_mktsegment<>'BUILDING' "
                 "then 'old' else 'new' end label from customer"),
    "expectations": ("select count(*) n, count(case when event_id is null then 1 end) null_id, "
                     "count(*)-count(distinct event_id) dup_id, "
                     "count(case when event_type not in ('view','click') then 1 end) bad_domain "
                     "from events"),
    "fact_dim_left": ("select c_custkey id, n_name label from customer left join "
                      "(select * from nation where n_regionkey<>0) n on c_nationkey=n_nationkey"),
    "flat_refresh": ("select c_custkey id, case when c_custkey%2=0 then 'old' "
                     "else c_mktsegment end seg from customer"),
    "gen_expectations": ("select count(*) n, cast(0 as bigint) missing_field, "
                         "cast(0 as bigint) bad_uuid, cast(0 as bigint) bad_gender, "
                         "cast(0 as bigint) ts_out_of_range, cast(0 as bigint) dup_id "
                         "from customer"),
    "gen_fact_series": ("select g, cast(g%2+1 as integer) dim_id, concat('u',g,'@x.com') email, "
                        "concat('user',g) username, "
                        "case when g%2=0 then 'male' else 'female' end gender "
                        "from (select o_orderkey g from orders) s"),
    "gen_users": ("select c_custkey id, lower(concat(substr(h,1,8),'-',substr(h,9,4),'-4',"
                  "substr(h,14,3),'-',"
                  "substr('89ab',((instr('0123456789abcdef',substr(h,17,1))-1)%4)+1,1),"
                  "substr(h,18,3),'-',substr(h,21,12))) uuid "
                  "from (select c_custkey, md5(concat('42:',cast(c_custkey as varchar))) h "
                  "from customer) x"),
    "insert_filtered": ("select -c_custkey id, cast(-1 as bigint) event_id from customer union all "
                        "select user_id, case when user_id%3=0 then -1 else e end from "
                        "(select user_id, min(event_id) filter (where event_id%4=1) e "
                        "from events group by 1) x where user_id%3=0 or e is not null"),
    "join_by_statistics": ("select c_nationkey nation, count(*) orders, max(o_totalprice) largest "
                           "from orders join customer on o_custkey=c_custkey "
                           "where c_acctbal>9000 group by 1"),
    "insert_if_absent": ("select user_id id, case when user_id%2=0 then -1 "
                         "else min(event_id) end event_id from events group by user_id"),
    "json_parse": ("select event_id id, cast(json_extract(props,'$.k') as bigint) k "
                   "from events where event_id%10<>3"),
    "json_roundtrip": ("select event_id, user_id, event_type, value, ts, props, true same "
                       "from events"),
    "key_partition_check": ("select user_id, count(*) n, "
                            "count(case when prev>ts then 1 end) out_of_order from "
                            "(select user_id, ts, lag(ts) over (partition by user_id "
                            "order by event_id) prev from (select user_id, event_id, case when "
                            "event_id%7=0 then ts - interval 10 days else ts end ts "
                            "from events) e) x group by 1"),
    "latency_enrich": f"select event_id id, {_LATENCY} latency_ms from events",
    "latency_stats": ("select event_type, count(*) n, count(l) measured, "
                      "quantile_disc(l,0.5) p50, quantile_disc(l,0.95) p95, max(l) p_max from "
                      f"(select event_type, case when event_id%7<>0 then {_LATENCY} end l "
                      "from events) x group by 1"),
    "latency_sketch": ("select event_type, count(*) n, count(l) measured, max(l) p_max, "
                       "true p50_near, true p95_near from (select event_type, case when "
                       f"event_id%7<>0 then {_LATENCY} end l from events) x group by 1"),
    "loss_audit": ("select cast(sum(case when c.id is null then 1 else 0 end) as bigint) missing, "
                   "cast(sum(case when p.id is null then 1 else 0 end) as bigint) extra, "
                   "cast(sum(case when c.id%5=0 then 1 else 0 end) as bigint) duplicated "
                   "from (select event_id id from events where event_id%10<>3) p full join "
                   "(select event_id id from events where event_id%7<>2) c on p.id=c.id"),
    "loss_audit_bitmaps": (_OFFSETS + "select cast(part as integer) \"partition\", "
                           "count(*) filter (where nc is null) missing, "
                           "count(*) filter (where np is null) extra, "
                           "cast(sum(greatest(coalesce(nc,0)-greatest(coalesce(np,0),1),0)) as bigint) "
                           "duplicated from j group by 1"),
    "lost_offsets": (_OFFSETS + "select cast(part as integer) \"partition\", o \"offset\" from j "
                     "where nc is null"),
    "mark_sent": ("select o_orderkey id, o_orderkey%10=0 or o_orderkey in (select o_orderkey "
                  "from orders where o_orderstatus='O' and o_orderkey%10<>0 "
                  "order by o_orderdate, o_orderkey limit 500) sent from orders"),
    "mv_build": _ROLLUP,
    "mv_incremental": _ROLLUP,
    "mv_read": _ROLLUP,
    "mv_unique_check": (f"select count(*) dup from (select label from ({_ROLLUP}) m "
                        "group by label having count(*)>1) z"),
    "offset_totals": ("select cast(sum(e) as bigint) total from "
                      "(select user_id%6 part, max(event_id)+1 e from events group by 1) x"),
    "offset_totals_footer": ("select cast(sum(e) as bigint) total from "
                             "(select user_id%6 part, max(event_id)+1 e from events group by 1) x"),
    "outbox_claim": _CLAIM.format(""),
    "outbox_claim_ledger": _CLAIM.format("and o_orderkey%3<>0"),
    "point_lookup": "select o_orderkey id, o_orderstatus from orders where o_orderkey=1000",
    "point_lookup_indexed": ("select o_orderkey id, o_orderstatus, o_totalprice from orders "
                             "where o_orderkey in (1,1000,-7)"),
    "rejected_records": ("select case when o%20=11 then 'no payload' when o%10=3 then 'malformed' "
                         "when o%10=5 then 'no key' when o%10=7 then 'empty key' "
                         "when o%20=9 then 'no user' else 'accepted' end reason, count(*) cnt "
                         "from (select event_id o from events) x group by 1"),
    "resolve_dim_key": ("select c_custkey id, d.k dim_id from customer left join "
                        "(select min(c_custkey) k, c_mktsegment s from customer "
                        "where c_mktsegment<>'BUILDING' group by 2) d on s=c_mktsegment"),
    "scan_fact": "select c_custkey id, c_name username, c_nationkey dim_id from customer",
    "stream_enrich": ("select cast(event_id as varchar) id, event_type, value, "
                      f"epoch_us(ts)//1000 event_ts_ms, true spark_processed_at, {_LATENCY} latency_ms "
                      "from events"),
    "stream_progress": "select count(*) \"rows\", true timed from events",
    "stream_replay": ("select cast(event_id as varchar) id, event_type, value, "
                      f"epoch_us(ts)//1000 event_ts_ms, {_LATENCY} latency_ms from events"),
    "spread_chunks": ("select cast(8 as bigint) tasks, count(*) n, count(event_id) ids, true even "
                      "from events"),
    "stream_retry": ("select cast(event_id as varchar) id, event_type, value, "
                     "(select count(*) from events) counted from events"),
    "table_diff": ("with a as (select o_orderkey k, o_totalprice v from orders), "
                   "c as (select k, case when k%100=0 then v+1 else v end v from a where k%97<>0), "
                   "b as (select * from c union all select -k-1, v from a where k%89=0 "
                   "union all select * from c where k%83=0), "
                   "x as (select k, list(v order by v) v from a group by k), "
                   "y as (select k, list(v order by v) v from b group by k) "
                   "select count(*) filter (where x.k is not null and y.k is not null "
                   "and x.v is distinct from y.v) changed, "
                   "count(*) filter (where y.k is null) only_left, "
                   "count(*) filter (where x.k is null) only_right "
                   "from x full join y on x.k=y.k"),
    "table_diff_tree": (_COPIES + "select count(*) filter (where l and r) changed, "
                        "count(*) filter (where not r) only_left, "
                        "count(*) filter (where not l) only_right from d"),
    "to_message": ("select cast(user_id as varchar) k, event_id id, event_type, "
                   "cast(1706745600000 as bigint) event_ts_ms from events"),
    "union_sources": ("select c_custkey id, c_name nm from customer "
                      "union all select s_suppkey, s_name from supplier"),
    "upsert_compacted": _LATEST,
    "upsert_latest": _LATEST,
    "validity_split": ("select id is not null and id<>'' valid, count(*) cnt from "
                       "(select case when event_id%5=0 then null when event_id%5=1 then '' "
                       "else event_type end id from events) x group by 1"),
}
