"""Position ledger: one state machine per account, as a stream and as a batch replay."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql import types as T

from pairloom.operators.chunks import HOME, chunk_fold
from pairloom.operators.series import SeriesSpec
from pairloom.session import SESSION_CONF
from pairloom.streaming.published import publish, read_published

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

# Symbols of the legs, barrier margins, share of the balance per position, days held.
LEG_FOR = {1: "ETH-USD", 0: "BTC-USD"}
UPPER, LOWER = 0.662016, 0.220194
ALLOCATION = 0.1
MAX_DAYS = 2
START_BALANCE = 10_000.0
NEVER = -(1 << 62)


@dataclass(frozen=True)
class LedgerRules:
    """``barrier_basis``: levels around the spread of the ``message`` or of the ``open`` trade.

    ``reenter_same_step`` lets a step that closed a position open the next one.
    """

    upper: float = UPPER
    lower: float = LOWER
    allocation: float = ALLOCATION
    max_days: int = MAX_DAYS
    barrier_basis: str = "message"
    reenter_same_step: bool = True


@dataclass
class Account:
    symbol: str | None = None
    amount: float = 0.0
    position_value: float = 0.0
    balance: float = START_BALANCE
    days: int = 0
    open_spread: float = 0.0


def step(acc: Account, rules: LedgerRules, prediction, message_spread: float, spread: float,
         prices: dict[str, float]) -> str:
    """Apply one message to the account; returns what happened: close, open, reopen or hold."""
    did = ""
    if acc.symbol is not None:
        acc.days += 1
        basis = message_spread if rules.barrier_basis == "message" else acc.open_spread
        outside = spread >= basis * (1 + rules.upper) or spread <= basis * (1 - rules.lower)
        if acc.days >= rules.max_days or outside:
            acc.balance += acc.amount * prices[acc.symbol]
            acc.symbol, acc.amount, acc.position_value, acc.days, acc.open_spread = None, 0.0, 0.0, 0, 0.0
            did = "close"
    if acc.symbol is None and (rules.reenter_same_step or not did):
        leg = LEG_FOR.get(int(prediction)) if prediction is not None and not pd.isna(prediction) else None
        cost = acc.balance * rules.allocation
        if leg is not None and cost <= acc.balance:
            acc.symbol, acc.amount, acc.position_value = leg, cost / prices[leg], cost
            acc.balance -= cost
            acc.open_spread, acc.days = spread, 0
            did = "reopen" if did else "open"
    return did or "hold"


OUTPUT = ("msg_id string, ts timestamp, action string, symbol string, amount double, position_value double, "
          "account_balance double, days_in_trade int, trade_open_spread double")
_NAMES = [field.split()[0] for field in OUTPUT.split(", ")]


def _row(m, did: str, acc: Account) -> tuple:
    return (m.msg_id, m.ts, did, acc.symbol, acc.amount, acc.position_value, acc.balance, acc.days, acc.open_spread)


def _play(rows, acc: Account, rules: LedgerRules) -> Iterator[tuple]:
    for m in rows:
        did = step(acc, rules, m.prediction, m.message_spread, m.spread,
                   {LEG_FOR[1]: m.price_eth, LEG_FOR[0]: m.price_btc})
        yield _row(m, did, acc)


def replay(signals: DataFrame, rules: LedgerRules = LedgerRules(), balance: float = START_BALANCE,
           chunk_rows: int = 4096) -> DataFrame:
    """Run the ledger over stored signals, one row out per signal.

    Columns: account, ts, msg_id, prediction, message_spread, spread, price_eth, price_btc. An
    open position is at most ``max_days`` steps old and every balance scales with its
    start, so a chunk is fully described by its result for each age it may start with. Long
    accounts are thus replayed chunk by chunk.
    """
    back = rules.max_days
    if rules.allocation > 1:
        raise ValueError("allocation must not exceed the balance")

    def entered(pdf: pd.DataFrame, age: int, equity: float) -> Account | None:
        """Account with a position opened ``age`` rows before the chunk (0: flat)."""
        acc = Account(balance=equity)
        if age:
            before = pdf[~pdf[HOME]]
            if len(before) < age:
                return None
            m = before.iloc[-age]
            if pd.isna(m.prediction):
                return None
            leg = LEG_FOR[int(m.prediction)]
            cost = equity * rules.allocation
            price = m.price_eth if leg == LEG_FOR[1] else m.price_btc
            acc = Account(leg, cost / price, cost, equity - cost, age - 1, float(m.spread))
        return acc

    def equity_of(acc: Account) -> float:
        return acc.balance + acc.position_value

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        home = pdf[pdf[HOME]]
        out: dict[str, float] = {}
        for age in range(back + 1):
            acc = entered(pdf, age, 1.0)
            if acc is None:
                out[f"age{age}"], out[f"gain{age}"] = -1, np.nan
                continue
            for _ in _play(home.itertuples(), acc, rules):
                pass
            out[f"age{age}"] = acc.days + 1 if acc.symbol else 0
            out[f"gain{age}"] = equity_of(acc)
        return pd.DataFrame([out])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        age, equity, rows = 0, balance, []
        for s in pdf.itertuples():
            rows.append((age, equity))
            equity *= getattr(s, f"gain{age}")
            age = int(getattr(s, f"age{age}"))
        return pd.DataFrame(rows, columns=["entry_age", "entry_equity"])

    def apply(pdf: pd.DataFrame) -> pd.DataFrame:
        acc = entered(pdf, int(pdf["entry_age"].iloc[0]), float(pdf["entry_equity"].iloc[0])) if len(pdf) else None
        return pd.DataFrame(list(_play(pdf[pdf[HOME]].itertuples(), acc, rules)), columns=_NAMES)

    spec = SeriesSpec(("account",), "ts", ties=("msg_id",), chunk_rows=chunk_rows)
    ddl = ", ".join(f"age{a} int, gain{a} double" for a in range(back + 1))
    return chunk_fold(signals, spec, summarise, ddl, fold, "entry_age int, entry_equity double", apply, OUTPUT, back=back)


class LedgerProcessor(StatefulProcessor):
    """Keyed state of one account across micro-batches."""

    STATE = "symbol string, amount double, position_value double, balance double, days int, open_spread double, last_ts long"

    def __init__(self, rules: LedgerRules = LedgerRules(), balance: float = START_BALANCE):
        self.rules, self.start = rules, balance

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.account = handle.getValueState("account", self.STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        stored = self.account.get() if self.account.exists() else None
        acc, last = (Account(*stored[:6]), stored[6]) if stored is not None else (Account(balance=self.start), NEVER)
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "msg_id"])
        micros = batch["ts"].astype("datetime64[us]").astype("int64")
        late = batch[micros < last]
        played = [_row(m, "late", acc) for m in late.itertuples()] + list(_play(batch[micros >= last].itertuples(), acc, self.rules))
        out = pd.DataFrame(played, columns=_NAMES)
        last = max(int(last), int(micros.max()))
        self.account.update((acc.symbol, acc.amount, acc.position_value, acc.balance, acc.days, acc.open_spread, last))
        out.insert(0, "account", key[0])
        yield out

    def handleInitialState(self, key, initialState, timerValues) -> None:
        s = initialState.iloc[0]
        symbol = None if pd.isna(s["symbol"]) or not s["symbol"] else s["symbol"]
        self.account.update((symbol, float(s["amount"]), float(s["position_value"]), float(s["account_balance"]),
                             int(s["days_in_trade"]), float(s["trade_open_spread"]), NEVER))

    def close(self) -> None:
        pass


def ledger_stream(signals: DataFrame, rules: LedgerRules = LedgerRules(), balance: float = START_BALANCE,
                  accounts: DataFrame | None = None) -> DataFrame:
    """Streaming ledger over the columns of ``replay``; ``accounts`` gives stored start states.

    The rows an account gets within one micro-batch are played in time order; the trigger limit
    of the source bounds how many that are. A row older than the last one played comes out with the action
    ``late`` and changes nothing. This operator needs the RocksDB state store, which
    is set on the session.
    """
    signals.sparkSession.conf.set(STATE_STORE, SESSION_CONF[STATE_STORE])
    initial = accounts.groupBy("account") if accounts is not None else None
    return signals.groupBy("account").transformWithStateInPandas(
        statefulProcessor=LedgerProcessor(rules, balance),
        outputStructType=T.StructType([T.StructField("account", T.StringType()), *T.StructType.fromDDL(OUTPUT).fields]),
        outputMode="Append", timeMode="None", initialState=initial)


#: groups of accounts that an event-time ledger keeps by default
GROUPS = 256
#: rows of one part of a group's state and of its output
PART_ROWS = 10_000

# a waiting message; its time is kept in microseconds, which mean the same in every time zone
MESSAGE = pa.schema([
    ("account", pa.string()), ("micros", pa.int64()), ("msg_id", pa.string()), ("prediction", pa.int32()), ("message_spread", pa.float64()),
    ("spread", pa.float64()), ("price_eth", pa.float64()), ("price_btc", pa.float64())])
ACCOUNT = pa.schema([
    ("account", pa.string()), ("symbol", pa.string()), ("amount", pa.float64()), ("position_value", pa.float64()), ("balance", pa.float64()),
    ("days", pa.int64()), ("open_spread", pa.float64())])


def _micros(ts: pd.Series) -> pd.Series:
    return ts.astype("datetime64[us]").astype("int64")


def _messages(rows: pd.DataFrame) -> pa.Table:
    columns = {**{c: rows[c] for c in MESSAGE.names if c != "micros"}, "micros": _micros(rows["ts"])}
    return pa.Table.from_arrays([pa.array(columns[f.name], from_pandas=True).cast(f.type) for f in MESSAGE], schema=MESSAGE)


def _packed(table: pa.Table) -> list[tuple[bytes]]:
    """Rows of a list state, each with some rows of ``table``."""
    out = []
    for lo in range(0, table.num_rows, PART_ROWS):
        part = pa.BufferOutputStream()
        with pa.ipc.new_stream(part, table.schema) as writer:
            writer.write_table(table.slice(lo, PART_ROWS).combine_chunks())
        out.append((part.getvalue().to_pybytes(),))
    return out


def _unpacked(parts: Iterator[tuple], schema: pa.Schema) -> pa.Table:
    return pa.concat_tables([schema.empty_table(), *(pa.ipc.open_stream(part).read_all() for (part,) in parts)])


def _milliseconds(micros: int) -> int:
    """Rounded up, as timers count in milliseconds."""
    return -int(-micros // 1000)


class EventTimeLedger(StatefulProcessor):
    """Keyed state of a group of accounts whose messages wait for the watermark.

    Waiting messages are a list in the state store, some rows in each of its elements; one timer stands at the earliest of them. When the
    watermark has passed it no older message can come any more, so all messages up to the watermark are played in time order, each on its
    own account, and the timer moves on. A call of the state store costs more than a hundred messages, which is why accounts share them.
    """

    def __init__(self, rules: LedgerRules = LedgerRules(), balance: float = START_BALANCE):
        self.rules, self.start = rules, balance

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.accounts = handle.getListState("accounts", "accounts binary")
        self.waiting = handle.getListState("waiting", "messages binary")
        self.timer = handle.getValueState("timer", "at long")

    def _move_timer(self, at: int) -> None:
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, parts = None, []
        for part in rows:
            messages = _messages(part)
            parts += _packed(messages)
            least = _milliseconds(pc.min(messages["micros"]).as_py())
            first = least if first is None else min(first, least)
        if first is not None:
            self.waiting.appendList(parts)
            timer = self.timer.get()[0] if self.timer.exists() else None
            if timer is None or first < timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self._move_timer(first)
        return iter(())

    def _played(self, due: pd.DataFrame, accounts: dict[str | None, Account]) -> pd.DataFrame:
        rows = []
        for m in due.itertuples(index=False):
            acc = accounts.get(m.account)
            if acc is None:
                acc = accounts[m.account] = Account(balance=self.start)
            did = step(acc, self.rules, m.prediction, m.message_spread, m.spread, {LEG_FOR[1]: m.price_eth, LEG_FOR[0]: m.price_btc})
            rows.append((did, acc.symbol, acc.amount, acc.position_value, acc.balance, acc.days, acc.open_spread))
        out = pd.DataFrame(rows, columns=_NAMES[2:], index=due.index)
        for k, (name, values) in enumerate((("account", due["account"]), ("msg_id", due["msg_id"]), ("ts", due["micros"].astype("datetime64[us]")))):
            out.insert(k, name, values)
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        accounts: dict[str | None, Account] = {}
        for row in _unpacked(self.accounts.get(), ACCOUNT).to_pylist():
            accounts.setdefault(row.pop("account"), Account(**row))
        waiting = _unpacked(self.waiting.get(), MESSAGE)
        passed = pc.less_equal(waiting["micros"], now)
        due, later = waiting.filter(passed).sort_by([("micros", "ascending"), ("msg_id", "ascending")]), waiting.filter(pc.invert(passed))
        for lo in range(0, due.num_rows, PART_ROWS):
            yield self._played(due.slice(lo, PART_ROWS).to_pandas(), accounts)
        if later.num_rows:
            self._move_timer(_milliseconds(pc.min(later["micros"]).as_py()))
            self.waiting.put(_packed(later))
        else:
            self.timer.clear()
            self.waiting.clear()
        if accounts:
            self.accounts.put(_packed(self._table(accounts)))

    @staticmethod
    def _table(accounts: dict[str | None, Account]) -> pa.Table:
        fields = [[*accounts], *zip(*(astuple(a) for a in accounts.values()))]
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(fields, ACCOUNT)], schema=ACCOUNT)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        accounts = {}
        for s in initialState.to_dict("records"):
            symbol = None if pd.isna(s["symbol"]) or not s["symbol"] else s["symbol"]
            accounts.setdefault(s["account"], Account(symbol, float(s["amount"]), float(s["position_value"]), float(s["account_balance"]),
                                                      int(s["days_in_trade"]), float(s["trade_open_spread"])))
        self.accounts.appendList(_packed(self._table(accounts)))

    def close(self) -> None:
        pass


def ledger_in_event_time(signals: DataFrame, rules: LedgerRules = LedgerRules(), balance: float = START_BALANCE,
                         accounts: DataFrame | None = None, groups: int = GROUPS) -> DataFrame:
    """Streaming ledger over the columns of ``replay``, whose ``ts`` has a watermark, in event time.

    A message waits until the watermark has passed it and is then played behind all older ones of its account, so the rows are those of
    ``replay`` however messages fall into files and batches, as long as none comes later than the delay of the
    watermark; later ones are dropped by Spark. What waits is bounded by the messages of one delay. The messages of the last delay come
    out when newer ones, of any account, move the watermark.

    Accounts are dealt over ``groups`` by the hash of their name, and a worker holds the waiting messages of one group at a time: raise the
    number with millions of messages a group. It belongs to the checkpoint and can't change with it; results don't depend on it.
    """
    signals.sparkSession.conf.set(STATE_STORE, SESSION_CONF[STATE_STORE])
    group = F.pmod(F.xxhash64("account"), F.lit(groups)).cast("int")
    initial = accounts.withColumn("_group", group).groupBy("_group") if accounts is not None else None
    return signals.withColumn("_group", group).groupBy("_group").transformWithStateInPandas(
        statefulProcessor=EventTimeLedger(rules, balance),
        outputStructType=T.StructType([T.StructField("account", T.StringType()), *T.StructType.fromDDL(OUTPUT).fields]),
        outputMode="Append", timeMode="EventTime", initialState=initial)


def position_rows(ledger: DataFrame) -> DataFrame:
    """Row of the position table per step."""
    return ledger.select(
        F.to_date("ts").alias("date"), F.date_format("ts", "HH:mm:ss").alias("time"), "symbol",
        F.lit("USD").alias("currency"), F.col("amount").cast("decimal(38,5)").alias("position_size"),
        F.col("trade_open_spread").cast("decimal(38,5)").alias("trade_open_spread"),
        F.col("account").alias("account_id"), "msg_id")


def balance_rows(ledger: DataFrame) -> DataFrame:
    """Row of the balance table per step."""
    return ledger.select(F.to_date("ts").alias("date"), F.col("account").alias("account_id"), "account_balance", "msg_id")


TABLES = {"positions": position_rows, "balances": balance_rows}


def write_ledger(path: str, run: str = "0"):
    """``foreachBatch`` sink that publishes each micro-batch in both tables at once (``published.publish``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # read twice below; cached blocks are rebuilt from the batch if an executor is lost
        batch = batch.persist()
        try:
            publish(batch.sparkSession, path, run, batch_id, {name: rows(batch) for name, rows in TABLES.items()})
        finally:
            batch.unpersist()
    return write


def read_ledger(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The published rows of the table ``name`` (positions or balances) with run and batch_id; an empty one before the first commit."""
    return read_published(spark, path, name, "msg_id string")
