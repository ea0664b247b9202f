"""Configuration: column names, business rules and table locations.

Everything a transform needs is passed in explicitly as a frozen dataclass,
so the same functions serve batch runs, streaming micro-batches and tests.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from decimal import Decimal

# ---------------------------------------------------------------------------
# These must equal the ledger contract for results to agree.
#   transaction type codes, in contract order:
#     WITHDRAWAL, TRANSFER_OUT, TRANSFER_IN, DEPOSIT, WALLET_CREATED
#   daily rate 0.00055; minimum balance 100 (strictly greater earns);
#   money type decimal(18,2);
#   Gold table directories: daily_cdi_stagin_audit, daily_cdi_bonus,
#   account_balance_last_day_cdi
# ---------------------------------------------------------------------------
TRANSACTION_TYPES: tuple[str, ...] = (
    "WITHDRAWAL",
    "TRANSFER_OUT",
    "TRANSFER_IN",
    "DEPOSIT",
    "WALLET_CREATED",
)
DAILY_RATE = "0.00055"
MIN_BALANCE = "100"
MONEY_TYPE = "decimal(18,2)"
AUDIT_TABLE_DIR = "daily_cdi_stagin_audit"
PAYOUT_TABLE_DIR = "daily_cdi_bonus"
BALANCE_TABLE_DIR = "account_balance_last_day_cdi"

# Events outside [first, last) are quarantined: one impossible time would move
# a data-driven cutoff and stretch every daily balance to its date.
TIME_RANGE: tuple[dt.datetime, dt.datetime] = (dt.datetime(1970, 1, 1), dt.datetime(2100, 1, 1))

# Rates are carried as decimal(9,8): exact, and wide enough for any daily rate.
RATE_TYPE = "decimal(9,8)"


@dataclass(frozen=True)
class Columns:
    """Column names of the event contract and of every derived table."""

    event_id: str = "event_id"
    user_id: str = "user_id"
    account_id: str = "account_id"
    transaction_type: str = "transaction_type"
    event_time: str = "event_time"
    amount: str = "amount"
    cdi_applicable: str = "cdi_applicable"
    amount_cdi_applicable: str = "amount_cdi_applicable"
    amount_cdi_not_applicable: str = "amount_cdi_not_applicable"
    total_amount: str = "total_amount"
    balance_to_apply_cdi: str = "balance_to_apply_cdi"
    cdi_bonus: str = "cdi_bonus"
    final_balance: str = "final_balance"
    current_balance: str = "current_balance"
    last_day_bonus: str = "last_day_bonus"
    cdi_bonus_date: str = "cdi_bonus_date"
    business_date: str = "business_date"
    run_id: str = "run_id"

    @property
    def event_columns(self) -> list[str]:
        return [
            self.event_id,
            self.user_id,
            self.account_id,
            self.transaction_type,
            self.event_time,
            self.amount,
        ]

    @property
    def silver_columns(self) -> list[str]:
        return [
            self.account_id,
            self.total_amount,
            self.amount_cdi_applicable,
            self.amount_cdi_not_applicable,
        ]


@dataclass(frozen=True)
class AccrualRule:
    """Interest rule: ``bonus = base * rate`` when ``base > min_balance``.

    ``min_balance=None`` drops the threshold; ``base="total"`` tests the
    threshold on ``total_amount``; the rate always applies to the accrual base.
    """

    rate: str = DAILY_RATE
    min_balance: str | None = MIN_BALANCE
    base: str = "accrual"  # "accrual" | "total"

    def __post_init__(self) -> None:
        Decimal(self.rate)  # reject non-numeric text early
        if self.base not in ("accrual", "total"):
            raise ValueError(f"unknown accrual base {self.base!r}")


@dataclass(frozen=True)
class TablePaths:
    """Every table location derives from one root (quarantine included).

    The root is a path of any store that Spark reads (``s3a://bucket/lake``,
    ``hdfs://nn:8020/lake``, ``file:///lake``, ``/lake``) and is kept as given.
    """

    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def source(self) -> str:
        return self._p("raw")

    @property
    def routed(self) -> str:
        """Bronze is one table partitioned by route: valid rows and quarantine."""
        return self._p("bronze", "routed")

    @property
    def bronze(self) -> str:
        return self._p("bronze", "routed", "route=valid")

    @property
    def quarantine(self) -> str:
        return self._p("bronze", "routed", "route=quarantine")

    @property
    def silver(self) -> str:
        return self._p("silver", "accounts")

    @property
    def seen_events(self) -> str:
        """Events folded so far, as sorted runs (``sources.runs``)."""
        return self._p("silver", "_seen_events")

    @property
    def fold_routed(self) -> str:
        """Batches of the incremental fold, partitioned by route and batch."""
        return self._p("silver", "_routed")

    @property
    def fold_quarantine(self) -> str:
        """Rows that the incremental fold rejected, partitioned by batch."""
        return self._p("silver", "_routed", "route=quarantine")

    @property
    def metrics(self) -> str:
        """What streams reported per micro-batch."""
        return self._p("_metrics")

    @property
    def audit(self) -> str:
        return self._p("gold", AUDIT_TABLE_DIR)

    @property
    def payout(self) -> str:
        return self._p("gold", PAYOUT_TABLE_DIR)

    @property
    def balance(self) -> str:
        return self._p("gold", BALANCE_TABLE_DIR)

    @property
    def daily_payout(self) -> str:
        """Per-calendar-day payouts, partitioned by business date."""
        return self._p("gold", "daily_payout")

    @property
    def checkpoints(self) -> str:
        return self._p("_checkpoints")


@dataclass(frozen=True)
class LedgerConfig:
    """One document for the whole pipeline."""

    cols: Columns = field(default_factory=Columns)
    rule: AccrualRule = field(default_factory=AccrualRule)
    transaction_types: tuple[str, ...] = TRANSACTION_TYPES
    # Event times from the first to before the last are taken.
    time_range: tuple[dt.datetime, dt.datetime] = TIME_RANGE
    # Type event ids are brought to ("long" or "string"); None: text ids stay text, numbers become long.
    event_id_type: str | None = None
    # Eligibility cutoff; None means "derive from the data" (midnight of max - 24h).
    cutoff: dt.datetime | None = None
    # Without a cutoff: the day of the run; the cutoff is midnight of the day before it.
    run_date: dt.date | None = None

    def with_(self, **changes) -> "LedgerConfig":
        return replace(self, **changes)


def ledger_config_from_dict(d: dict) -> LedgerConfig:
    """Build a ``LedgerConfig`` from plain values (e.g. one JSON document).

    Keys: ``columns`` (name overrides), ``rate``, ``min_balance`` (null for no
    threshold), ``accrual_base``, ``transaction_types``, ``event_id_type``
    ("long", "string" or null: as delivered), ``cutoff`` (ISO text or null), ``run_date`` (ISO date or null for data-driven). Missing keys keep
    defaults.
    """
    rule = AccrualRule(
        rate=str(d.get("rate", DAILY_RATE)),
        min_balance=None if d.get("min_balance", MIN_BALANCE) is None else str(d.get("min_balance", MIN_BALANCE)),
        base=d.get("accrual_base", "accrual"),
    )
    cutoff = d.get("cutoff")
    return LedgerConfig(
        cols=Columns(**d.get("columns", {})),
        rule=rule,
        transaction_types=tuple(d.get("transaction_types", TRANSACTION_TYPES)),
        time_range=tuple(dt.datetime.fromisoformat(t) for t in d["time_range"]) if d.get("time_range") else TIME_RANGE,
        event_id_type=d.get("event_id_type"),
        cutoff=None if cutoff is None else dt.datetime.fromisoformat(cutoff),
        run_date=None if d.get("run_date") is None else dt.date.fromisoformat(d["run_date"]),
    )
