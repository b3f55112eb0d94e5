"""The catalog's queries restated in DuckDB SQL, straight from their definitions: every event is copied into every
window that holds it and grouped there; point-in-time lookups are ASOF joins. Quotients are rounded from their full
decimal text, because rounding a binary product first can lift a value just below a tie over it."""

from __future__ import annotations

MINUTE, HOUR = 60_000_000, 3_600_000_000
EPOCH_US = 1704067200000000
AS_OF_US = EPOCH_US + 2 * HOUR

_TX = f"""
ev as (
  select *, cast(json_extract(props, '$.k') as int) as k,
         {EPOCH_US} + (epoch_us(ts) - {EPOCH_US}) // 360 as event_us
  from events),
tx as (
  select event_id, k, event_us, 'tx-' || event_id as transaction_id, 'user-' || user_id as user_id,
         cast(round(value * 100) as bigint) as amount_cents,
         cast(round(value * 100) as bigint) / 100::double as amount,
         'EUR' as currency, 'merch-' || (k % 20) as merchant_id,
         (['FR', 'NG', 'RO', 'CN', 'US', 'DE'])[1 + k % 6] as merchant_country, 'FR' as user_country,
         case when k % 10 <> 0 then 'device-' || (k % (1 + user_id % 7)) end as device_id,
         case event_type when 'error' then 'FAILED' when 'signup' then 'DECLINED'
              when 'view' then 'PENDING' else 'APPROVED' end as status,
         case when event_type in ('error', 'signup')
              then (['INSUFFICIENT_FUNDS', 'CARD_BLOCKED', 'WRONG_PIN'])[1 + k % 3] end as failure_reason,
         cast(k as varchar) as metadata_k
  from ev)"""


def _windows(source: str, length: int, slide: int, where: str = "true") -> str:
    return (
        f"(select *, unnest(generate_series((event_us // {slide}::bigint) * {slide}::bigint - {length - slide}::bigint, "
        f"(event_us // {slide}::bigint) * {slide}::bigint, {slide}::bigint)) + {length}::bigint as window_end "
        f"from {source} where {where})"
    )


def _grouped(name: str, body: str, length: int, slide: int, where: str = "true") -> str:
    return f"""
{name} as (
  select user_id, window_end - {length}::bigint as window_start, window_end, {body}, max(event_us) as last_event_time
  from {_windows('tx', length, slide, where)} group by user_id, window_end)"""


_F01 = _grouped("f01", """count(*) as total_tx, count(*) filter (status = 'APPROVED') as approved_tx,
         count(*) filter (status = 'FAILED') as failed_tx""", 5 * MINUTE, MINUTE)


def _f02(length: int = 24 * HOUR, slide: int = HOUR) -> str:
    return _grouped("f02", """sum(amount_cents)::double / count(*) / 100 as avg_amount,
         round(stddev_samp(amount_cents) / 100, 4) as stddev_amount,
         max(amount_cents)::double / 100 as max_amount, min(amount_cents)::double / 100 as min_amount,
         sum(amount_cents)::double / 100 as sum_amount""", length, slide, "status = 'APPROVED'")


_F04 = _grouped("f04_counts", f"""count(*) filter (event_us >= window_end - {MINUTE}::bigint) as cnt_1m,
         count(*) filter (event_us >= window_end - {5 * MINUTE}::bigint) as cnt_5m,
         count(*) as cnt_1h""", HOUR, MINUTE) + """,
f04 as (
  select user_id, window_start, window_end, cnt_1m, cnt_5m, cnt_1h,
         round(0.5::double / (1 + exp(-(cnt_1m - 3)::double)) + 0.3::double / (1 + exp(-(cnt_5m - 8)::double))
               + 0.2::double / (1 + exp(-(cnt_1h - 20)::double)), 4) as velocity_score,
         last_event_time
  from f04_counts)"""

_F05 = _grouped("f05_counts", """count(distinct device_id) as distinct_devices,
         string_agg(distinct device_id, ',' order by device_id) as known_devices""",
                24 * HOUR, HOUR, "device_id is not null") + """,
f05 as (
  select user_id, window_start, window_end, known_devices, distinct_devices,
         distinct_devices > 1 as device_change_flag,
         case distinct_devices when 1 then 0.0::double when 2 then 0.3::double when 3 then 0.6::double
              when 4 then 0.8::double else 0.9::double end as device_score,
         last_event_time
  from f05_counts)"""

_F06 = _grouped("f06_counts", """count(*) filter (status = 'FAILED') as failed_count,
         count(*) filter (status = 'DECLINED') as declined_count,
         count(*) filter (failure_reason = 'INSUFFICIENT_FUNDS') as insufficient_funds,
         count(*) filter (failure_reason = 'CARD_BLOCKED') as card_blocked,
         count(*) filter (status = 'FAILED' and amount < 5.0) as small_amount_fails""", 30 * MINUTE, 5 * MINUTE) + """,
f06 as (
  select user_id, window_start, window_end, failed_count, declined_count, insufficient_funds, card_blocked,
         small_amount_fails, failed_count > 10 as credential_stuffing, small_amount_fails > 3 as card_testing,
         failed_count > 10 or small_amount_fails > 3 as hard_block, last_event_time
  from f06_counts)"""

_F03 = """
profiles as (
  select 'user-' || c_custkey as user_id,
         case when c_acctbal >= 0 then (['FR', 'US', 'GB', 'DE', 'NG'])[1 + c_nationkey % 5] end as home_country
  from customer),
f03_risk as (
  select transaction_id, tx.user_id, event_us as event_time, merchant_country, home_country,
         case when home_country is null then 0.0::double
              when (merchant_country, home_country) in (('NG', 'US'), ('RO', 'GB'), ('CN', 'DE')) then 0.8::double
              when merchant_country <> home_country then 0.4::double
              else 0.0::double end as risk_score
  from tx left join profiles using (user_id)),
f03 as (
  select transaction_id, user_id, event_time, risk_score > 0 as mismatch, risk_score, risk_score >= 0.8 as is_unusual
  from f03_risk)"""

_K1 = f"""
k1 as (
  select f01.user_id, f01.window_end as event_timestamp, total_tx as tx_last_5min_total,
         approved_tx as tx_last_5min_approved, failed_tx as tx_last_5min_failed,
         case when f01.window_end - f02.window_end <= {24 * HOUR}::bigint then avg_amount end as avg_amount_24h,
         case when f01.window_end - f02.window_end <= {24 * HOUR}::bigint then stddev_amount end as stddev_amount_24h,
         case when f01.window_end - f04.window_end <= {5 * MINUTE}::bigint then velocity_score end as velocity_score,
         case when f01.window_end - f05.window_end <= {24 * HOUR}::bigint then distinct_devices end
           as distinct_devices_24h,
         case when f01.window_end - f05.window_end <= {24 * HOUR}::bigint then device_change_flag end
           as device_change_flag,
         case when f01.window_end - f06.window_end <= {30 * MINUTE}::bigint then failed_count end
           as failed_attempts_30min,
         case when f01.window_end - f06.window_end <= {30 * MINUTE}::bigint then hard_block end as hard_block,
         f01.last_event_time
  from f01
  asof left join f02 on f01.user_id = f02.user_id and f01.window_end >= f02.window_end
  asof left join f04 on f01.user_id = f04.user_id and f01.window_end >= f04.window_end
  asof left join f05 on f01.user_id = f05.user_id and f01.window_end >= f05.window_end
  asof left join f06 on f01.user_id = f06.user_id and f01.window_end >= f06.window_end)"""

_K2 = """
k2 as (
  select transaction_id, user_id, event_time as event_timestamp, mismatch as country_mismatch_flag,
         risk_score as country_risk_score, is_unusual as is_unusual_country
  from f03)"""

_LOOKUP = f"""
live_users as (
  select * from k1 where {AS_OF_US} < event_timestamp + {24 * HOUR}::bigint
  qualify row_number() over (partition by user_id order by last_event_time desc, event_timestamp) = 1),
live_tx as (select * from k2 where {AS_OF_US} < event_timestamp + {10 * MINUTE}::bigint),
looked_up as (
  select tx.transaction_id, tx.user_id, tx_last_5min_total, tx_last_5min_failed, avg_amount_24h, velocity_score,
         device_change_flag, failed_attempts_30min, hard_block, country_mismatch_flag, country_risk_score
  from tx left join live_users on tx.user_id = live_users.user_id
       left join live_tx on tx.transaction_id = live_tx.transaction_id)"""

_DECIDED = """
points as (
  select *, least(10000, 400 * coalesce(tx_last_5min_total, 0) + 900 * coalesce(tx_last_5min_failed, 0)
           + 500 * coalesce(failed_attempts_30min, 0) + 1500 * cast(coalesce(device_change_flag, false) as int)
           + cast(round(coalesce(velocity_score, 0) * 10000) as bigint)
           + cast(round(coalesce(country_risk_score, 0) * 5000) as bigint)) / 10000::double as linear
  from looked_up),
decided as (
  select transaction_id, user_id, hard_block,
         case when coalesce(hard_block, false) then 1.0::double else linear end as score,
         case when coalesce(hard_block, false) then 'BLOCKED' when linear >= 0.85 then 'FRAUD'
              else 'CLEARED' end as decision
  from points)"""

_FLAWED = """
flawed as (
  select transaction_id, case when k <> 57 then user_id end as user_id, case when k <> 41 then amount end as amount,
         case k % 4 when 0 then 'EUR' when 1 then 'USD' else 'EUR' end as currency,
         case when k <> 13 then merchant_id end as merchant_id, merchant_country, user_country, device_id,
         case when k = 29 then 'REVERSED' else status end as status, failure_reason,
         (event_us // 1000) * 1000 as event_time,
         case when k % 5 <> 0 then 1 else 0 end::bigint as metadata_size,
         case when k % 5 <> 0 then metadata_k end as metadata_k,
         case k when 57 then 'missing user_id' when 41 then 'missing amount' when 13 then 'missing merchant_id'
                when 29 then 'unknown status' end as reject_reason
  from tx)"""

_FRAMES = """
frames as (
  select *, case k when 3 then 'missing' when 5 then 'too short' when 7 then 'bad magic byte' end as frame_error,
         case when k in (3, 5, 7) then null when k = 11 then 99 when k = 17 then 42 when k % 2 = 0 then 7 else 42 end
           ::bigint as schema_id
  from tx)"""


def _query(select: str, *parts: str) -> str:
    return "with " + ",".join([_TX, *parts]) + "\n" + select


_ALL_FEATURES = (_F01, _f02(), _F04, _F05, _F06, _K1)
_VALUES = "user_id, window_start, window_end"

ORACLE = {
    "tx_conformed": _query("select * exclude (reject_reason) from flawed where reject_reason is null", _FLAWED),
    "tx_rejected": _query(
        "select transaction_id, reject_reason from flawed where reject_reason is not null", _FLAWED),
    "wire_frame_split": _query(
        """select event_id, frame_error, schema_id,
                  case when frame_error is null and k <> 17 then transaction_id end as payload_id from frames""",
        _FRAMES),
    "tx_decoded": _query(
        """select event_id, coalesce(frame_error, case k when 11 then 'unknown schema id'
                    when 17 then 'unreadable body' end) as decode_error,
                  schema_id,
                  case when good then transaction_id end as transaction_id, case when good then user_id end as user_id,
                  case when good then amount end as amount,
                  case when good and schema_id = 42 then currency end as currency,
                  case when good then device_id end as device_id, case when good then status end as status,
                  case when good then event_us // 1000 end as event_time,
                  case when good and schema_id = 42 then metadata_k end as metadata_k
           from (select *, frame_error is null and k not in (11, 17) as good from frames)""",
        _FRAMES),
    "tx_publish_roundtrip": _query(
        """select user_id as key, transaction_id, user_id, amount, currency, merchant_id, merchant_country,
                  user_country, device_id, status, failure_reason, event_us // 1000 as event_time, metadata_k
           from tx"""),
    "tx_dedup": _query("select transaction_id, user_id, amount_cents, status, event_us from tx"),
    "f01_tx_counts": _query("select * from f01", _F01),
    "f02_amount_stats": _query("select * from f02", _f02()),
    "f03_country_risk": _query("select * from f03", _F03),
    "f04_velocity": _query("select * from f04", _F04),
    "f05_device_change": _query("select * exclude (known_devices) from f05", _F05),
    "f05_known_devices": _query("select user_id, window_end, distinct_devices, known_devices from f05", _F05),
    "f06_failed_attempts": _query("select * from f06", _F06),
    "f07_tumbling_velocity": _query(
        f"""select user_id, (event_us // {MINUTE}) * {MINUTE} as window_start,
                   (event_us // {MINUTE}) * {MINUTE} + {MINUTE} as window_end,
                   count(*) over (partition by user_id, event_us // {MINUTE}) as count,
                   transaction_id, amount_cents, status, device_id, event_us as event_time
            from tx
            qualify row_number() over (
              partition by user_id, event_us // {MINUTE} order by event_us, transaction_id) = 1"""),
    "amount_ratio": _query(
        f"""select transaction_id, user_id, amount, event_us as event_time, avg_amount,
                   case when avg_amount > 0 then round(cast(cast(amount / avg_amount as varchar) as decimal(38, 20)), 4)::double
                        else 1.0::double end as amount_ratio
            from (select tx.transaction_id, tx.user_id, tx.amount, tx.event_us,
                         case when tx.event_us - f02.window_end <= {24 * HOUR}::bigint then f02.avg_amount end
                           as avg_amount
                  from tx asof left join f02 on tx.user_id = f02.user_id and tx.event_us >= f02.window_end)""",
        _f02(HOUR, 5 * MINUTE)),
    "online_latest": _query(
        f"""select user_id, window_end, total_tx, approved_tx, failed_tx, last_event_time,
                   window_end + {10 * MINUTE}::bigint as expires_at,
                   case when window_end <= {EPOCH_US + HOUR} then 0 else 1 end::bigint as batch_id
            from (select * from f01
                  qualify row_number() over (partition by user_id order by last_event_time desc, window_end) = 1)
            where {AS_OF_US - MINUTE} < window_end + {10 * MINUTE}::bigint""",
        _F01),
    "online_lookup": _query("select * from looked_up", *_ALL_FEATURES, _F03, _K2, _LOOKUP),
    "multi_get": _query(
        f"""select c.user_id, 'feature:velocity:' || c.user_id as key, velocity_score, cnt_1m, cnt_5m, cnt_1h
            from (select 'user-' || c_custkey as user_id from customer) c
            left join (select * from f04
                       qualify row_number() over (
                         partition by user_id order by last_event_time desc, window_end) = 1) v
              on c.user_id = v.user_id and {AS_OF_US} < v.window_end + {5 * MINUTE}::bigint""",
        _F04),
    "user_features_wide": _query("select * from k1", *_ALL_FEATURES),
    "user_features_joined": _query("select * from k1", *_ALL_FEATURES),
    "transaction_features": _query("select * from k2", _F03, _K2),
    "labels_in_range": _query(
        f"""select user_id, transaction_id, cast(k % 13 = 0 as smallint) as label, event_us as event_timestamp
            from tx where event_us between {EPOCH_US + 30 * MINUTE} and {EPOCH_US + HOUR}"""),
    "training_dataset": _query(
        f"""select l.user_id, l.transaction_id, l.label, l.event_us as event_timestamp,
                   case when l.event_us - k1.event_timestamp <= {24 * HOUR}::bigint then avg_amount_24h end
                     as avg_amount_24h,
                   case when l.event_us - k1.event_timestamp <= {24 * HOUR}::bigint then velocity_score end
                     as velocity_score,
                   case when l.event_us - k1.event_timestamp <= {24 * HOUR}::bigint then device_change_flag end
                     as device_change_flag,
                   country_risk_score
            from (select *, cast(k % 13 = 0 as smallint) as label from tx
                  where event_us between {EPOCH_US + 30 * MINUTE} and {EPOCH_US + 105 * MINUTE}) l
            asof left join k1 on l.user_id = k1.user_id and l.event_us >= k1.event_timestamp
            left join k2 on l.transaction_id = k2.transaction_id""",
        *_ALL_FEATURES, _F03, _K2),
    "feature_vector": _query(
        """select transaction_id, user_id, coalesce(tx_last_5min_total, 0)::double as tx_last_5min_total,
                  coalesce(tx_last_5min_failed, 0)::double as tx_last_5min_failed,
                  coalesce(avg_amount_24h, 0)::double as avg_amount_24h,
                  coalesce(velocity_score, 0)::double as velocity_score,
                  coalesce(device_change_flag, false)::int::double as device_change_flag,
                  coalesce(failed_attempts_30min, 0)::double as failed_attempts_30min,
                  coalesce(country_risk_score, 0)::double as country_risk_score
           from looked_up""",
        *_ALL_FEATURES, _F03, _K2, _LOOKUP),
    "decisions": _query("select * from decided", *_ALL_FEATURES, _F03, _K2, _LOOKUP, _DECIDED),
    "routed_alerts": _query(
        """select case decision when 'CLEARED' then 'cleared-transactions' else 'fraud-alerts' end as topic,
                  transaction_id as key, transaction_id, score, decision from decided""",
        *_ALL_FEATURES, _F03, _K2, _LOOKUP, _DECIDED),
    "pk_violations": _query(
        f"""select user_id, event_us // {MINUTE} as minute, count(*) as row_count
            from tx group by all having count(*) > 1"""),
    "constraint_violations": _query(
        """select 'transaction_id not null' as rule, count(*) filter (transaction_id is null) as violations from tx
           union all select 'user_id not null', count(*) filter (k = 57) from tx
           union all select 'label not null', count(*) filter (k = 41) from tx
           union all select 'label in (0, 1)', count(*) filter (k <> 41 and k % 3 = 2) from tx
           union all select 'event_timestamp not null', count(*) filter (event_us is null) from tx"""),
    "stream_tx_counts": _query(
        f"""select * from f01
            where window_end <= (select (max(event_us) // 1000) * 1000 from tx) - {10 * MINUTE}::bigint""",
        _F01),
    "stream_velocity_online": _query(
        """select user_id, window_end, velocity_score, cnt_1m, cnt_5m, cnt_1h, last_event_time from f04
           qualify row_number() over (partition by user_id order by last_event_time desc, window_end) = 1""",
        _F04),
    "tx_decoded_timestamps": _query(
        """select transaction_id, amount, event_us // 1000 as event_time, null::varchar as decode_error from tx"""),
    "stream_rejects": _query(
        """select event_id, coalesce(frame_error, case k when 11 then 'unknown schema id' when 17 then 'unreadable body'
                    when 57 then 'missing user_id' when 41 then 'missing amount' when 13 then 'missing merchant_id'
                    when 29 then 'unknown status' end) as reject_reason
           from frames""",
        _FRAMES),
    "online_user_row": _query(
        " full join ".join(
            ("select user_id, tx_last_5min_total, tx_last_5min_approved, tx_last_5min_failed, avg_amount_24h, "
             "stddev_amount_24h, velocity_score, distinct_devices_24h, device_change_flag, failed_attempts_30min, "
             "hard_block from " if i == 0 else "")
            + f"""(select user_id, {columns} from {name} qualify row_number() over (
                     partition by user_id order by last_event_time desc, window_end) = 1) as {name}_now
            """ + (" using (user_id)" if i else "")
            for i, (name, columns) in enumerate((
                ("f01", "total_tx as tx_last_5min_total, approved_tx as tx_last_5min_approved, "
                        "failed_tx as tx_last_5min_failed"),
                ("f02", "avg_amount as avg_amount_24h, stddev_amount as stddev_amount_24h"),
                ("f04", "velocity_score"),
                ("f05", "distinct_devices as distinct_devices_24h, device_change_flag"),
                ("f06", "failed_count as failed_attempts_30min, hard_block")))),
        _F01, _f02(), _F04, _F05, _F06),
    "online_compacted": _query(
        f"""select user_id, window_end, total_tx, approved_tx, failed_tx, last_event_time,
                   window_end + {10 * MINUTE}::bigint as expires_at
            from (select * from f01
                  qualify row_number() over (partition by user_id order by last_event_time desc, window_end) = 1)
            where {AS_OF_US - MINUTE} < window_end + {10 * MINUTE}::bigint""",
        _F01),
    "model_scores": _query("select transaction_id, user_id, linear as score from points",
                           *_ALL_FEATURES, _F03, _K2, _LOOKUP, _DECIDED),
    "stream_country_risk": _query("select * from f03", _F03),
    "stream_dedup": _query(
        """select user_id, window_end, total_tx, approved_tx, failed_tx, last_event_time from f01
           qualify row_number() over (partition by user_id order by last_event_time desc, window_end) = 1""",
        _F01),
    "created_at": _query(f"select *, {AS_OF_US} as created_at from k2", _F03, _K2),
    "key_values": _query(
        f"""select 'feature:velocity:' || user_id as key, velocity_score, cnt_1m, cnt_5m, cnt_1h,
                   300::bigint as ttl_seconds,
                   strftime(make_timestamp(window_end), '%Y-%m-%d %H:%M:%S') as known_at
            from f04 qualify row_number() over (
              partition by user_id order by last_event_time desc, window_end) = 1""",
        _F04),
}
ORACLE["training_from_store"] = ORACLE["training_dataset"]
ORACLE["stream_velocity_panes"] = ORACLE["stream_velocity_online"]
ORACLE["stream_tumbling"] = (
    "select * from (" + ORACLE["f07_tumbling_velocity"] + ") where window_end <= "
    f"(select (max(event_time) // 1000) * 1000 from ({ORACLE['tx_dedup'].replace('event_us from tx', 'event_us as event_time from tx')}))"
    " - 10000000")

_NOW = "qualify row_number() over (partition by user_id order by last_event_time desc, window_end) = 1"
ORACLE["stream_amount_panes"] = _query(f"select * exclude (window_start) from f02 {_NOW}", _f02())
ORACLE["stream_device_panes"] = _query(f"select * exclude (window_start, known_devices) from f05 {_NOW}", _F05)
ORACLE["stream_known_devices"] = _query(
    f"""select tx.user_id, device_id, max(event_us) as last_event_time
        from tx join (select * from f05 {_NOW}) now
          on tx.user_id = now.user_id and event_us >= window_start and event_us < window_end
        where device_id is not null group by all""",
    _F05)
_AT_ONE = EPOCH_US + HOUR
ORACLE["stream_scoring"] = _query(
    "select * from decided", *_ALL_FEATURES, _F03, _K2,
    f"""
deliveries as (
  select (event_us > {_AT_ONE})::int as delivery, max(event_us) as as_of from tx group by delivery),
live_users as (
  select k1.*, delivery from k1, deliveries
  where (delivery = 1 or event_timestamp <= {_AT_ONE}) and as_of < event_timestamp + {24 * HOUR}::bigint
  qualify row_number() over (partition by delivery, user_id order by last_event_time desc, event_timestamp) = 1),
live_tx as (
  select k2.*, delivery from k2, deliveries
  where (delivery = 1 or event_timestamp <= {_AT_ONE}) and as_of < event_timestamp + {10 * MINUTE}::bigint),
looked_up as (
  select tx.transaction_id, tx.user_id, tx_last_5min_total, tx_last_5min_failed, avg_amount_24h, velocity_score,
         device_change_flag, failed_attempts_30min, hard_block, country_mismatch_flag, country_risk_score
  from tx left join live_users on tx.user_id = live_users.user_id and (event_us > {_AT_ONE})::int = live_users.delivery
       left join live_tx on tx.transaction_id = live_tx.transaction_id and (event_us > {_AT_ONE})::int = live_tx.delivery)""",
    _DECIDED)
ORACLE["stream_dedup_history"] = _query("select transaction_id, user_id, (k % 2)::bigint as batch_id from tx")
ORACLE["stream_late_rows"] = _query(
    f"""select transaction_id, case when event_us < bound then bound - event_us end as lateness_us
        from tx left join (
          select delivery, (select max(event_us) from tx where k % 4 < delivery) - {10 * MINUTE}::bigint as bound
          from range(4) r(delivery)) on k % 4 = delivery""")
_BROKEN = {
    "missing transaction_id": "false", "missing user_id": "k = 57", "missing amount": "k in (41, 29)",
    "missing merchant_id": "k = 13", "missing merchant_country": "k = 41", "missing user_country": "false",
    "missing status": "false", "missing event_time": "false", "unknown status": "k = 29",
}
ORACLE["tx_violations"] = _query(
    "select event_id, violations from (select event_id, concat_ws(',', "
    + ", ".join(f"case when {broken} then '{rule}' end" for rule, broken in _BROKEN.items())
    + ") as violations from tx) where violations <> ''")
ORACLE["violation_counts"] = _query(
    "select 'rows' as rule, count(*) as violations from tx"
    + "".join(f" union all select '{rule}', count(*) filter ({broken}) from tx" for rule, broken in _BROKEN.items()))

ORACLE["tx_decoded_registry"] = _query(
    """select event_id, null::varchar as decode_error, 1000 + w as schema_id, transaction_id, user_id, amount,
              case when w % 2 = 0 then currency end as currency, device_id, status, event_us // 1000 as event_time,
              case when w % 3 <> 0 then metadata_k end as metadata_k
       from (select *, event_id % 200 as w from tx)""")
ORACLE["store_commits"] = _query(
    f"""select transaction_id, country_risk_score, side, state
        from k2, (values ('online'), ('offline')) s(side), (values ('failed'), ('pushed again')) t(state)
        where state = 'pushed again' or event_timestamp % 3 <> 1""",
    _F03, _K2)
ORACLE["online_bucketed"] = _query(
    f"""select transaction_id, tx.user_id, total_tx, approved_tx, failed_tx
        from tx left join (select * from f01 {_NOW}) now
          on tx.user_id = now.user_id and {AS_OF_US - MINUTE} < window_end + {10 * MINUTE}::bigint""",
    _F01)
_LIMITS = {
    "tx_last_5min_total": 2, "tx_last_5min_failed": 0.5, "avg_amount_24h": 256, "velocity_score": 0.125,
    "device_change_flag::int": 0.5, "failed_attempts_30min": 0.5, "country_risk_score": 0.25,
}
_BITS = ", ".join(f"coalesce(coalesce({name}, 0) > {limit}, false)::int as b{i}" for i, (name, limit) in enumerate(_LIMITS.items()))
ORACLE["fitted_scores"] = _query(
    f"""select transaction_id, user_id,
               round(cast(cast(1 / (1 + exp(calm - risky)) as varchar) as decimal(38, 20)), 4)::double as score
        from (select transaction_id, user_id, max(weight) filter (label = 0) as calm, max(weight) filter (label = 1) as risky
              from weighed group by all)""",
    *_ALL_FEATURES, _F03, _K2, _LOOKUP,
    f"""
learnt as (
  select label, count(*) as n, sum(count(*)) over () as total,
         {", ".join(f"(sum(b{i}) + 1) / (count(*) + 2) as p{i}" for i in range(7))}
  from (select k % 13 = 0 as label, {_BITS}
        from (select * from tx where event_us between {EPOCH_US + 30 * MINUTE} and {EPOCH_US + 105 * MINUTE}) l
        asof left join k1 on l.user_id = k1.user_id and l.event_us >= k1.event_timestamp
        left join k2 on l.transaction_id = k2.transaction_id)
  group by label),
weighed as (
  select transaction_id, user_id, label::int as label, ln(n + 1) - ln(total + 2)
         + {" + ".join(f"ln(case b{i} when 1 then p{i} else 1 - p{i} end)" for i in range(7))} as weight
  from (select transaction_id, user_id, {_BITS} from looked_up), learnt)""")
