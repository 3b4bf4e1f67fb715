import datetime as dt

import numpy as np
import pandas as pd
import pytest
from helpers import close
from pyspark.sql import functions as F

from pairloom.streaming import ledger
from pairloom.streaming.predictions import run_once

COLS = "account string, ts timestamp, msg_id string, prediction int, message_spread double, spread double, price_eth double, price_btc double"


def signals(n=150, accounts=("a", "b"), seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for acc in accounts:
        for i in range(n):
            out.append((acc, dt.datetime(2020, 1, 1) + dt.timedelta(days=i), f"{acc}{i:04d}", [0, 1, None][rng.integers(0, 3)],
                        float(rng.normal()), float(rng.normal()), float(100 + rng.normal()), float(1000 + 10 * rng.normal())))
    return out


def loop(rows, rules):
    acc, out = {}, []
    for a, ts, mid, pred, ms, sp, pe, pb in rows:
        s = acc.setdefault(a, ledger.Account())
        did = ledger.step(s, rules, pred, ms, sp, {"ETH-USD": pe, "BTC-USD": pb})
        out.append((mid, did, s.symbol, s.balance))
    return pd.DataFrame(out, columns=["msg_id", "action", "symbol", "balance"]).sort_values("msg_id").reset_index(drop=True)


def test_golden_buy_then_close():
    rules = ledger.LedgerRules(reenter_same_step=False)
    acc = ledger.Account()
    spread, price = -0.23413695694918055, 129.0661
    assert ledger.step(acc, rules, 1, spread, spread, {"ETH-USD": price, "BTC-USD": 1.0}) == "open"
    assert acc.symbol == "ETH-USD" and acc.open_spread == spread
    close([acc.position_value, acc.balance, acc.amount], [1000.0, 9000.0, 1000 / price])
    assert ledger.step(acc, rules, 1, spread, spread, {"ETH-USD": 128.1310, "BTC-USD": 1.0}) == "close"
    close([acc.balance], [10000 + (128.1310 - price) * acc_size(price)])
    assert acc.symbol is None and acc.position_value == 0


def acc_size(price):
    return 1000 / price


def test_holds_two_days_then_closes():
    acc = ledger.Account()
    prices = {"ETH-USD": 10.0, "BTC-USD": 20.0}
    seen = [ledger.step(acc, ledger.LedgerRules(reenter_same_step=False), 0, 1.0, 1.0, prices) for _ in range(4)]
    assert seen == ["open", "hold", "close", "open"]
    acc = ledger.Account()
    seen = [ledger.step(acc, ledger.LedgerRules(), 0, 1.0, 1.0, prices) for _ in range(4)]
    assert seen == ["open", "hold", "reopen", "hold"]


def test_not_enough_balance():
    acc = ledger.Account(balance=100.0)
    assert ledger.step(acc, ledger.LedgerRules(allocation=1.5), 1, 0.0, 0.0, {"ETH-USD": 1.0, "BTC-USD": 1.0}) == "hold"


@pytest.mark.parametrize("rules", [
    ledger.LedgerRules(), ledger.LedgerRules(0.2, 0.2, barrier_basis="open"), ledger.LedgerRules(reenter_same_step=False),
    ledger.LedgerRules(5.0, 5.0, max_days=4, barrier_basis="open")])
def test_replay_in_chunks_is_the_loop(spark, rules):
    rows = signals()
    want = loop(rows, rules)
    for chunk in (11, 1000):
        out = ledger.replay(spark.createDataFrame(rows, COLS), rules, chunk_rows=chunk).toPandas().sort_values("msg_id").reset_index(drop=True)
        assert out.action.tolist() == want.action.tolist()
        assert out.symbol.where(out.symbol.notna(), None).tolist() == want.symbol.where(want.symbol.notna(), None).tolist()
        close(out.account_balance, want.balance)


def test_stream_over_batches_is_the_loop_and_sinks_repeat_safely(spark, tmp_path):
    rows, rules = signals(n=60), ledger.LedgerRules()
    want = loop(rows, rules)
    df = spark.createDataFrame(rows, COLS)
    for lo, hi in (("2020-01-01", "2020-01-20"), ("2020-01-20", "2020-02-10"), ("2020-02-10", "2020-12-31")):
        df.where((df.ts >= lo) & (df.ts < hi)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sink = ledger.write_ledger(str(tmp_path / "out"))

    def twice(batch, batch_id):
        sink(batch, batch_id)
        sink(batch, batch_id)

    run_once(ledger.ledger_stream(stream, rules), "", str(tmp_path / "ckpt"), foreach=twice)
    out = ledger.read_ledger(spark, str(tmp_path / "out"), "balances").toPandas().sort_values("msg_id").reset_index(drop=True)
    assert out.msg_id.tolist() == want.msg_id.tolist() and out.batch_id.nunique() == 3
    close(out.account_balance, want.balance)


def test_late_messages_change_nothing(spark, tmp_path):
    rows = signals(n=30, accounts=("a",))
    late = [("a", rows[5][1], "a-late", 1, 0.1, 0.2, 100.0, 1000.0)]
    for k, part in enumerate((rows[:20], rows[20:] + late)):
        spark.createDataFrame(part, COLS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(COLS).parquet(str(tmp_path / "in"))
        run_once(ledger.ledger_stream(stream), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    out = spark.read.parquet(str(tmp_path / "out")).toPandas().sort_values("msg_id").reset_index(drop=True)
    assert out[out.msg_id == "a-late"].action.tolist() == ["late"]
    played = out[out.msg_id != "a-late"].reset_index(drop=True)
    close(played.account_balance, loop(rows, ledger.LedgerRules()).balance)


def test_runs_do_not_overwrite_each_other(spark, tmp_path):
    batch = spark.createDataFrame([("a", "m1", dt.datetime(2020, 1, 1), "open", "ETH-USD", 1.0, 1.0, 1.0, 0, 0.0)],
                                  "account string, msg_id string, ts timestamp, action string, symbol string, amount double, position_value double, "
                                  "account_balance double, days_in_trade int, trade_open_spread double")
    for run in ("one", "two", "two"):
        ledger.write_ledger(str(tmp_path / "out"), run)(batch, 0)
    assert ledger.read_ledger(spark, str(tmp_path / "out"), "positions").count() == 2


def test_both_tables_are_published_together(spark, tmp_path, monkeypatch):
    """A failure between the two writes shows the batch in neither table; the next attempt shows it in both, once."""
    schema = ("account string, msg_id string, ts timestamp, action string, symbol string, amount double, position_value double, "
              "account_balance double, days_in_trade int, trade_open_spread double")

    def batch(k):
        return spark.createDataFrame([("a", f"m{k}", dt.datetime(2020, 1, 1 + k), "open", "ETH-USD", 1.0, 1.0, 1.0, 0, 0.0)], schema)

    def seen():
        return [sorted(r.msg_id for r in ledger.read_ledger(spark, str(tmp_path / "out"), name).collect()) for name in ledger.TABLES]

    def broken(df):
        return ledger.balance_rows(df).where(F.raise_error(F.lit("disk")).isNull())

    sink = ledger.write_ledger(str(tmp_path / "out"))
    with monkeypatch.context() as m:
        m.setitem(ledger.TABLES, "balances", broken)
        with pytest.raises(Exception, match="disk"):
            sink(batch(0), 0)
    assert seen() == [[], []]
    sink(batch(0), 0)
    assert seen() == [["m0"], ["m0"]]
    with monkeypatch.context() as m:
        m.setitem(ledger.TABLES, "balances", broken)
        with pytest.raises(Exception, match="disk"):
            sink(batch(1), 1)
    assert seen() == [["m0"], ["m0"]]
    for _ in range(2):
        sink(batch(1), 1)
    assert seen() == [["m0", "m1"], ["m0", "m1"]]


@pytest.mark.parametrize("per_batch", [1, 100])
def test_event_time_does_not_depend_on_files_and_batches(spark, tmp_path, per_batch):
    rows, rules = signals(n=40), ledger.LedgerRules()
    want = loop(rows, rules)
    rng = np.random.default_rng(1)
    order = rng.permutation(len(rows))
    for k in range(3):  # no file is in time order, the latest messages come first
        part = [rows[i] for i in order[::-1][k::3]]
        spark.createDataFrame(part, COLS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(COLS).option("maxFilesPerTrigger", per_batch).parquet(str(tmp_path / "in")).withWatermark("ts", "60 days")
    run_once(ledger.ledger_in_event_time(stream, rules), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    early = spark.read.schema(f"account string, {ledger.OUTPUT}").parquet(str(tmp_path / "out")).count()
    clock = ("clock", dt.datetime(2030, 1, 1), "clock", None, 0.0, 0.0, 1.0, 1.0)
    spark.createDataFrame([clock], COLS).write.mode("append").parquet(str(tmp_path / "in"))
    run_once(ledger.ledger_in_event_time(stream, rules), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    out = spark.read.parquet(str(tmp_path / "out")).toPandas().sort_values("msg_id").reset_index(drop=True)
    assert early == 0 and out.msg_id.tolist() == want.msg_id.tolist() and out.action.tolist() == want.action.tolist()
    close(out.account_balance, want.balance)


def test_event_time_plays_what_the_watermark_has_passed(spark, tmp_path):
    rows = signals(n=30, accounts=("a",))
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(COLS).parquet(str(tmp_path / "in")).withWatermark("ts", "5 days")
    seen = []
    for part in (rows[3:12][::-1] + rows[:3], rows[12:][::-1]):
        spark.createDataFrame(part, COLS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run_once(ledger.ledger_in_event_time(stream), str(tmp_path / "out"), str(tmp_path / "ckpt"))
        seen.append(spark.read.parquet(str(tmp_path / "out")).count())
    assert seen == [7, 25]
    out = spark.read.parquet(str(tmp_path / "out")).toPandas().sort_values("msg_id").reset_index(drop=True)
    close(out.account_balance, loop(rows[:25], ledger.LedgerRules()).balance)


def test_stored_account_is_the_start_state(spark, tmp_path):
    accounts = spark.createDataFrame([("a", "ETH-USD", 2.0, 200.0, 800.0, 1, 0.5)],
                                     "account string, symbol string, amount double, position_value double, "
                                     "account_balance double, days_in_trade int, trade_open_spread double")
    rows = [("a", dt.datetime(2020, 1, 1), "m1", None, 1.0, 1.0, 110.0, 1000.0)]
    spark.createDataFrame(rows, COLS).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(COLS).parquet(str(tmp_path / "in"))
    run_once(ledger.ledger_stream(stream, accounts=accounts), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    row = spark.read.parquet(str(tmp_path / "out")).first()
    assert row.action == "close" and row.account_balance == 1020.0


def test_accounts_of_a_group_keep_their_own_state(spark, tmp_path):
    """Many accounts share a group, some with a stored start state; what waits and what is held goes over batches."""
    accounts = [f"a{k}" for k in range(7)]
    rows, rules = signals(n=25, accounts=accounts), ledger.LedgerRules()
    held = [("a0", "ETH-USD", 2.0, 200.0, 800.0, 1, 0.5), ("a3", "", 0.0, 0.0, 500.0, 0, 0.0)]
    start = {"a0": ledger.Account("ETH-USD", 2.0, 200.0, 800.0, 1, 0.5), "a3": ledger.Account(balance=500.0)}
    want = {}
    for a, ts, mid, pred, ms, sp, pe, pb in rows:
        acc = start.setdefault(a, ledger.Account())
        want[mid] = (a, ts, ledger.step(acc, rules, pred, ms, sp, {"ETH-USD": pe, "BTC-USD": pb}), acc.symbol, acc.balance)
    stored = spark.createDataFrame(held, "account string, symbol string, amount double, position_value double, "
                                         "account_balance double, days_in_trade int, trade_open_spread double")
    clock = ("clock", dt.datetime(2030, 1, 1), "clock", None, 0.0, 0.0, 1.0, 1.0)
    first, later = [r for r in rows if r[1] < dt.datetime(2020, 1, 15)], [r for r in rows if r[1] >= dt.datetime(2020, 1, 15)]
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(COLS).parquet(str(tmp_path / "in")).withWatermark("ts", "5 days")
    for part in (first[::-1], later[::-1], [clock]):
        spark.createDataFrame(part, COLS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run_once(ledger.ledger_in_event_time(stream, rules, accounts=stored, groups=2), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    out = spark.read.parquet(str(tmp_path / "out")).toPandas().set_index("msg_id")
    assert sorted(out.index) == sorted(want)
    for mid, (a, ts, did, symbol, cash) in want.items():
        row = out.loc[mid]
        assert (row.account, row.ts, row.action) == (a, ts, did) and (row.symbol or None) == symbol
        close([row.account_balance], [cash])
