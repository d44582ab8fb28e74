"""label_edges / tx_edges / bridge_edges fixtures (FIXTURES.md §4)."""

import datetime as dt
from decimal import Decimal

from lapse.config import Windows
from lapse.operators.membership import bridge_keys, existence_flag, key_audit
from lapse.plans.activity import account_activity
from lapse.plans.labels import eligible_from, label_from

W = Windows()
TX_SCHEMA = ("trans_id long, account_id long, d date, amount decimal(18,2), balance decimal(18,2), "
             "amount_cents long, balance_cents long")
D = dt.date


def tx(spark, rows):
    return spark.createDataFrame(
        [(i, a, d, Decimal(str(amt)), None if bal is None else Decimal(str(bal)),
          int(round(amt * 100)), None if bal is None else int(round(bal * 100)))
         for i, (a, d, amt, bal) in enumerate(rows)], TX_SCHEMA)


def spine(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "account_id long")


def test_label_edges(spark):
    opened = D(1997, 1, 1)
    rows = []
    # account 1..10: normal, base mean 100, label means 10..100 -> ratios 0.1..1.0
    for a in range(1, 11):
        rows += [(a, opened, 1, 1), (a, D(1998, 6, 1), 100, 100), (a, D(1999, 6, 1), 10 * a, 10 * a)]
    rows += [(20, opened, 1, 1)]                                       # no base-year rows -> removed
    rows += [(21, opened, 1, 1), (21, D(1998, 5, 5), 0, 0)]           # zero base mean -> removed
    rows += [(22, opened, 1, 1), (22, D(1998, 5, 5), -5, -5)]         # negative base mean -> removed
    rows += [(23, opened, 1, 1), (23, D(1998, 5, 5), 100, 100)]       # no label rows -> churned 0
    ids = list(range(1, 11)) + [20, 21, 22, 23]
    act = eligible_from(account_activity(tx(spark, rows), W), spine(spark, ids), W)
    lab = {r.account_id: r for r in label_from(act, W).collect()}
    assert set(lab) == set(range(1, 11)) | {23}
    assert lab[23].churned == 0 and lab[23].balance_ratio is None
    # ratios 0.1..1.0 -> 10th percentile (linear) = 0.1 + 0.9*0.1 = 0.19; ties at / below included
    churned = {a for a, r in lab.items() if r.churned == 1}
    assert churned == {1}


def test_label_threshold_tie_included(spark):
    opened = D(1997, 1, 1)
    rows = []
    for a, lab_amt in [(1, 50), (2, 50), (3, 50), (4, 100), (5, 100), (6, 100), (7, 100), (8, 100), (9, 100), (10, 100)]:
        rows += [(a, opened, 1, 1), (a, D(1998, 6, 1), 100, 100), (a, D(1999, 6, 1), lab_amt, lab_amt)]
    act = eligible_from(account_activity(tx(spark, rows), W), spine(spark, range(1, 11)), W)
    lab = {r.account_id: r.churned for r in label_from(act, W).collect()}
    assert {a for a, c in lab.items() if c} == {1, 2, 3}     # threshold 0.5 equals their ratio


def test_eligibility_boundary(spark):
    cut = W.obs_end - dt.timedelta(days=W.min_tenure_days)     # 1998-07-04
    rows = []
    for a, days in [(1, 179), (2, 180), (3, 181)]:
        rows += [(a, W.obs_end - dt.timedelta(days=days), 1, 1)]
    act = eligible_from(account_activity(tx(spark, rows), W), spine(spark, [1, 2, 3]), W)
    got = {r.account_id for r in act.collect()}
    assert cut == D(1998, 7, 4)
    assert got == {2, 3}


def test_tx_edges(spark):
    rows = [
        (1, D(1997, 3, 1), 10, 10),                                  # one-row account: std NULL
        (2, D(1997, 3, 1), 10, 5), (2, D(1997, 3, 1), 20, 7),         # same-day tie: last by trans_id
        (3, D(1997, 3, 1), 10, 9), (3, D(1997, 4, 1), 20, None),      # last balance NULL: skipped
    ]
    a = {r.account_id: r for r in account_activity(tx(spark, rows), W).collect()}
    assert a[1].obs_amt_std is None and a[1].tx_count == 1
    assert a[2].obs_bal_last == 700                            # cents
    assert a[3].obs_bal_last == 900 and a[3].obs_bal_min == 900


def test_bridge_edges(spark):
    disp = spark.createDataFrame([(100, 1), (101, 1), (102, 2), (7, 3)], "disp_id long, account_id long")
    card = spark.createDataFrame([(900, 100), (901, 101), (902, 555), (903, 1)], "card_id long, disp_id long")
    holders = {r.account_id for r in bridge_keys(card, disp, "disp_id", "disp_id", "account_id").collect()}
    assert holders == {1}                                   # two disps, one flag; unknown disp dropped
    sp = spine(spark, [1, 2, 3])
    flags = {r.account_id: r.has_card for r in existence_flag(sp, bridge_keys(card, disp, "disp_id", "disp_id",
                                                                           "account_id"), "account_id",
                                                              "has_card").collect()}
    assert flags == {1: 1, 2: 0, 3: 0}
    audit = key_audit(disp, card, "disp_id", "disp_id", "account_id", "account_id").first()
    # wrong path compares account ids with disp ids: account 1 collides with card.disp_id = 1
    assert (audit.n_right_path, audit.n_wrong_path, audit.n_overlap) == (1, 1, 1)


def test_hot_account_third_of_rows(spark):
    """One account holds a third of all transactions: aggregates stay exact
    (partial aggregation pools it map-side) and the label is unchanged."""
    rows = []
    for a in range(1, 31):
        rows += [(a, D(1997, 1, 1), 1, 1), (a, D(1998, 6, 1), 100, 100), (a, D(1999, 6, 1), 3 * a, 3 * a)]
    hot = [(1, D(1998, 3, 1) + dt.timedelta(days=i % 200), 100, 100) for i in range(len(rows) // 2)]
    df = tx(spark, rows + hot).repartition(7)
    act = {r.account_id: r for r in account_activity(df, W).collect()}
    assert act[1].base_bal_n == 1 + len(hot)
    assert act[1].base_bal_sum == 100 * 100 * (1 + len(hot))
    lab = {r.account_id: r.churned for r in label_from(eligible_from(account_activity(df, W), spine(spark, range(1, 31)), W), W).collect()}
    # ratios 0.03 .. 0.90 (the hot rows do not move account 1's base mean); brute-force threshold:
    ratios = sorted(3 * a / 100 for a in range(1, 31))
    pos = 0.1 * (len(ratios) - 1)
    thr = ratios[int(pos)] + (ratios[int(pos) + 1] - ratios[int(pos)]) * (pos - int(pos))
    assert {a for a, c in lab.items() if c} == {a for a in range(1, 31) if 3 * a / 100 <= thr}
