"""Random dirty payments through the whole chain, against a plain Python model."""

from collections import defaultdict
from datetime import datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from paylake.operators import account_day as days
from paylake.operators import quarantine
from paylake.operators.dedup import distinct_payments
from paylake.operators.merchant_hour import merchant_hour
from paylake.rules import Rules
from paylake.schemas import PAYMENT_COLUMNS, RAW_PAYMENTS

RULES = Rules(baseline_days=3, min_prior_days=2, spike_factor=2, burst_devices=2)

TIMES = [f"2025-05-{d:02d} {h:02d}:00:00" for d in range(1, 9) for h in (0, 12, 23)]
PAYMENT = st.tuples(
    st.sampled_from([None, *[f"T{i}" for i in range(40)]]),
    st.sampled_from([None, "ACC99999999", "A", "B", "C", "A", "B"]),
    st.sampled_from(["MER0000", "MER0050"]),
    st.just("MC00"),
    st.sampled_from([None, "junk", "1970-01-01 00:00:00", *TIMES]),
    st.sampled_from([None, "d1", "d2", "d3"]),
    st.sampled_from([None, "FAILED", "SUCCESS"]),
    st.sampled_from([None, "NA", "1.00", "2.50", "4.00", "10.00"]),
)


def nulls_last(row):
    return [(value is None, value or "") for value in row]


def survivors(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row if row[0] is None else row[0]].append(row)
    at = PAYMENT_COLUMNS.index("txn_ts")
    return [min(group, key=lambda r: (nulls_last([r[at]]), nulls_last(r))) for group in groups.values()]


def outcome(row):
    txn_id, account, _, _, ts, _, _, amount = row
    if amount in (None, "NA"):
        return "unparseable_amount"
    if account in (None, "ACC99999999"):
        return "unknown_account"
    if ts in (None, "junk") or not RULES.valid_from <= ts <= RULES.valid_to:
        return "timestamp_out_of_range"
    return "missing_txn_id" if txn_id is None else None


def model(rows):
    kept = survivors(rows)
    rejected = [(*row[:3], row[4], outcome(row)) for row in kept if outcome(row)]
    by_day, by_hour = defaultdict(list), defaultdict(list)
    for row in kept:
        if outcome(row) is None:
            ts = datetime.fromisoformat(row[4])
            by_day[row[1], ts.date()].append(row)
            by_hour[row[2], ts.hour].append(row[6])
    gold, history = [], defaultdict(list)
    for (account, day), group in sorted(by_day.items()):
        top = max(Decimal(row[7]) for row in group)
        devices = len({row[5] for row in group} - {None})
        prior = history[account][-RULES.baseline_days :]
        spike = len(prior) >= RULES.min_prior_days and top * len(prior) >= RULES.spike_factor * sum(prior)
        gold.append((account, day, len(group), top, devices, len(prior), spike, devices >= RULES.burst_devices))
        history[account].append(top)
    hours = [(m, h, len(s), s.count("FAILED")) for (m, h), s in by_hour.items()]
    return rejected, gold, hours


def collected(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(PAYMENT, min_size=1, max_size=120))
def test_chain_equals_the_model(spark, rows):
    raw = spark.createDataFrame(rows, RAW_PAYMENTS).repartition(3)
    classified = quarantine.classify(quarantine.parse(distinct_payments(raw)), RULES)
    silver = quarantine.clean(classified)
    rejected, gold, hours = model(rows)
    assert collected(quarantine.rejects(classified)) == sorted(rejected, key=str)
    columns = "account_id account_day txns max_amount distinct_devices prior_txn_count is_amount_spike is_device_burst"
    assert collected(days.account_day(silver, RULES).select(*columns.split())) == sorted(gold, key=str)
    assert collected(merchant_hour(silver).drop("failure_rate")) == sorted(hours, key=str)
