"""Resolving requests (J3, J5) and lookup accounting (A3-A5).

Two forms:

* ``resolve(requests, answers)``: recorded answers, a left equi-join on (name, type, class).
  Both sides are hash-partitioned on the key once; AQE splits a skewed key's partition.
* ``resolve_with(requests, lookup_factory)``: a caller-supplied lookup function, run inside
  ``mapInArrow`` with a window of outstanding lookups per task to overlap network waits.

Both give one attempt row per request: ``outcome`` is ``ok`` (a response, error codes such
as NXDOMAIN included), ``timeout``, ``failure`` or ``parse_failure`` (a name that cannot be
sent). Only ``ok`` attempts produce a response.
"""

from __future__ import annotations

import itertools
import queue
import threading
import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RCODE_NAMES
from ..session import ship_package

KEY = ["name", "type", "dclass"]
OUTCOMES = ("ok", "timeout", "failure", "parse_failure")


def question_key(name: str | Column = "name", dclass: str | Column = "dclass", rtype: str | Column = "type") -> Column:
    """``name TAB class TAB type``, the key of a raw response."""
    cols = [F.col(c) if isinstance(c, str) else c for c in (name, dclass, rtype)]
    return F.concat_ws("\t", *cols)


def valid_name(name: str | Column = "name") -> Column:
    """A name that can be put on the wire: labels of 1-63 bytes, each ending in a dot, or the root
    ``.``; at most 255 bytes in wire form. ``\\.`` and ``\\DDD`` are one byte of a label."""
    c = F.col(name) if isinstance(name, str) else name
    # one Latin-1 character per byte, escapes (and the dots they hold) as one plain character
    raw = F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
    raw = F.regexp_replace(raw, r"\\(?:[0-9]{3}|[^0-9])", "x")
    return (c == ".") | (raw.rlike(r"(?s)^([^.\\]{1,63}\.)+$") & (F.length(raw) <= 254))


def pick_nameserver(nameservers: Sequence[str], key: str | Column = "name") -> Column:
    """Spread requests over nameservers by a hash of the key: the first 60 bits of the MD5 of
    the key, modulo the number of servers. Repeatable on task retry (unlike a random pick)
    and reproducible by any tool that has MD5."""
    if not nameservers:
        raise ValueError("no nameservers")
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 15), 16, 10).cast("long")
    arr = F.array(*[F.lit(n) for n in nameservers])
    return F.element_at(arr, (F.pmod(h, F.lit(len(nameservers))) + 1).cast("int"))


def answer_rank(columns: Sequence[str]) -> Column:
    """Which of several answers to one question counts: a response before any failure, a failure before
    a timeout; then the smaller response code, then the faster one."""
    outcome = F.array_position(F.array(*[F.lit(o) for o in ("ok", "failure", "timeout")]), F.col("outcome"))
    parts = [F.when(outcome > 0, outcome).otherwise(9).alias("outcome")]
    if "rcode" in columns:
        codes = F.create_map(*[F.lit(x) for code, name in RCODE_NAMES.items() for x in (name, code)])
        parts.append(F.coalesce(F.try_element_at(codes, F.col("rcode")), F.lit(1 << 16)).alias("code"))
    if "ms" in columns:
        parts.append(F.col("ms").cast("long").alias("ms"))
    return F.struct(*parts)


def resolve(requests: DataFrame, answers: DataFrame, answers_unique: bool = False) -> DataFrame:
    """Attempt per request: ``name, type, dclass, question, outcome, rcode, ms`` (+ ``wire`` when the
    answers carry it). A request whose key has no recorded answer counts as a timeout. With
    several answers for one key the best by ``answer_rank`` is used, so each request gets at most
    one response. ``answers_unique`` promises one answer per key: nothing is ranked then, and a key
    that breaks the promise raises (the check is a count in the aggregate whose partitioning the join uses)."""
    payload = [c for c in ("outcome", "rcode", "ms", "wire") if c in answers.columns]
    kept = F.struct(*[F.col(c) for c in payload])
    if answers_unique:
        best = F.first(kept)
        many = F.count(F.lit(1)) > 1
        reduced = answers.groupBy(*KEY).agg(F.when(many, F.raise_error(F.lit("several answers for one key"))).otherwise(
            best).alias("__best"))
    else:
        # Aggregating on the join key leaves the answers hash-partitioned on it, so the join
        # below reuses that partitioning instead of shuffling the answers again.
        reduced = answers.groupBy(*KEY).agg(F.min_by(kept, F.struct(answer_rank(payload), kept)).alias("__best"))
    ans = reduced.select(*KEY, *[F.col(f"__best.{c}").alias(f"__a_{c}") for c in payload])
    req = requests.withColumn("__valid", valid_name("name"))
    j = req.join(ans, KEY, "left")
    outcome = (
        F.when(~F.col("__valid"), F.lit("parse_failure"))
        .otherwise(F.coalesce(F.col("__a_outcome"), F.lit("timeout")))
    )
    ok = outcome == "ok"
    out = [
        *[F.col(c) for c in requests.columns],
        question_key().alias("question"),
        outcome.alias("outcome"),
        F.when(ok, F.col("__a_rcode")).alias("rcode") if "rcode" in payload else F.lit(None).cast("string").alias("rcode"),
        F.when(F.col("__valid"), F.col("__a_ms")).alias("ms") if "ms" in payload else F.lit(None).cast("long").alias("ms"),
    ]
    if "wire" in payload:
        out.append(F.when(ok, F.col("__a_wire")).alias("wire"))
    return j.select(*out)


def responses(attempts: DataFrame) -> DataFrame:
    """Raw responses (``question, wire`` and ``rcode``) of the successful attempts."""
    cols = ["question"] + [c for c in ("wire", "rcode") if c in attempts.columns]
    return attempts.where(F.col("outcome") == "ok").select(*cols)


def rcode_counts(attempts: DataFrame) -> DataFrame:
    """Response-code histogram over the responses received."""
    return attempts.where(F.col("outcome") == "ok").groupBy("rcode").agg(F.count(F.lit(1)).alias("n"))


def lookup_summary(attempts: DataFrame) -> DataFrame:
    """Lookup totals and time shares, one row. Every attempt counts as a request. Time columns
    ``construct_ms``/``total_ms`` are used when present; the request time is ``ms``; the
    response-parse time is never measured and stays 0."""
    cols = attempts.columns
    perform = F.coalesce(F.sum("ms"), F.lit(0)).cast("long")
    construct = F.coalesce(F.sum("construct_ms"), F.lit(0)).cast("long") if "construct_ms" in cols else F.lit(0).cast("long")
    total = F.coalesce(F.sum("total_ms"), F.lit(0)).cast("long") if "total_ms" in cols else perform + construct
    o = F.col("outcome")

    def pct(x: Column) -> Column:
        return F.round(F.try_divide(x * F.lit(100.0), F.col("total_ms")), 4)

    return attempts.agg(
        F.count(F.lit(1)).alias("num_requests"),
        F.count_if(o == "ok").alias("responses"),
        F.count_if(o == "failure").alias("lookup_failures"),
        F.count_if(o == "timeout").alias("request_timeouts"),
        F.count_if(o == "parse_failure").alias("request_parse_failures"),
        construct.alias("construct_ms"),
        perform.alias("perform_ms"),
        F.lit(0).cast("long").alias("parse_ms"),
        total.alias("total_ms"),
    ).select(
        "*",
        pct(F.col("construct_ms")).alias("construct_pct"),
        pct(F.col("perform_ms")).alias("perform_pct"),
        pct(F.col("parse_ms")).alias("parse_pct"),
    )


# --- caller-supplied lookups --------------------------------------------------------------------

ATTEMPT_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("dclass", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("rcode", T.StringType()),
        T.StructField("ms", T.LongType()),
        T.StructField("wire", T.BinaryType()),
        T.StructField("construct_ms", T.LongType()),
        T.StructField("total_ms", T.LongType()),
        T.StructField("nameserver", T.StringType()),
    ]
)

Lookup = Callable[..., tuple[str | None, bytes | None]]


def resolve_with(
    requests: DataFrame,
    lookup_factory: Callable[[float], Lookup],
    threads: int = 50,
    timeout: float = 5.0,
    partitions: int | None = None,
    nameservers: Sequence[str] | None = None,
    outstanding: int = 5000,
) -> DataFrame:
    """Resolve with ``lookup_factory(timeout)`` -> ``lookup(name, type, dclass)`` returning
    ``(rcode, wire)``; it raises ``TimeoutError`` for a timeout and ``OSError`` for a failed
    lookup. The factory runs once per task; up to ``threads`` lookups run at once per task.
    With ``nameservers`` the one that ``pick_nameserver`` gives the name is handed on as a fourth
    argument. ``construct_ms`` is the time from taking up a request to its lookup, ``ms`` the lookup's.
    ``partitions`` spreads requests evenly first (round-robin, so no key can skew it).

    At most ``outstanding`` requests of a task are taken and not yet answered, over all batches: requests are taken from
    the input only as answers go out, in the order they come. A lookup still running after ``timeout``
    counts as a timeout, whatever becomes of it; another thread takes its place."""
    ship_package(requests.sparkSession)
    chosen = pick_nameserver(nameservers, "name") if nameservers else F.lit(None).cast("string")
    df = requests.select("name", "type", "dclass").withColumns({"__valid": valid_name("name"), "__ns": chosen})
    if partitions:
        df = df.repartition(partitions)

    def run(batches):
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(5))))
        done = LookupWindow(lookup_factory(timeout), threads, timeout, outstanding).results(rows)
        held, sent = [], time.monotonic()
        for attempt in done:
            if attempt is not None:
                held.append(attempt)
            if len(held) >= SEND_ROWS or (held and time.monotonic() - sent > SEND_SECONDS):
                yield _attempt_batch(held)
                held, sent = [], time.monotonic()
        yield _attempt_batch(held)

    return df.mapInArrow(run, ATTEMPT_SCHEMA)


SEND_ROWS, SEND_SECONDS = 1000, 1.0
LOST_THREADS = 1000  # lookups of a task that may hang for good before the task gives up


class LookupWindow:
    """Lookups of one task: ``threads`` at once, ``outstanding`` taken at most, each with a deadline."""

    def __init__(self, lookup: Lookup, threads: int, timeout: float, outstanding: int) -> None:
        self.lookup, self.timeout, self.outstanding = lookup, timeout, max(1, outstanding)
        self.threads = min(threads, self.outstanding)
        self.todo: queue.SimpleQueue = queue.SimpleQueue()
        self.done: queue.SimpleQueue = queue.SimpleQueue()
        self.lock = threading.Lock()
        self.running: dict[int, tuple[float, tuple]] = {}  # by number: when the lookup began, the request
        self.lost = 0

    def _work(self) -> None:
        while (item := self.todo.get()) is not None:
            number, taken, request = item
            name, rtype, dclass, ok, server = request
            if not ok:
                self.done.put((number, _attempt(request, "parse_failure", ms=None)))
                continue
            call = (name, rtype, dclass, server) if server is not None else (name, rtype, dclass)
            began = time.monotonic()
            with self.lock:
                self.running[number] = began, request
            rcode, wire, error = None, None, None
            try:
                rcode, wire = self.lookup(*call)
                outcome = "ok"
            except TimeoutError:
                outcome = "timeout"
            except OSError:
                outcome = "failure"
            except BaseException as e:  # noqa: BLE001  an error of the lookup's own fails the task
                outcome, error = "failure", e
            end = time.monotonic()
            with self.lock:
                if self.running.pop(number, None) is None:
                    return  # given up meanwhile, and replaced
            if error is None and end - began > self.timeout:
                rcode, wire, outcome = None, None, "timeout"
            self.done.put((number, error or _attempt(
                request, outcome, rcode, wire, int((end - began) * 1000), int((began - taken) * 1000), int((end - taken) * 1000))))

    def _start(self) -> None:
        threading.Thread(target=self._work, daemon=True).start()

    def _give_up(self) -> Iterator[tuple]:
        """Attempts of the lookups past their deadline."""
        now = time.monotonic()
        with self.lock:
            late = [n for n, (began, _) in self.running.items() if now - began > self.timeout]
            gone = [(self.running.pop(n)) for n in late]
        for began, request in gone:
            self.lost += 1
            if self.lost > LOST_THREADS:
                raise RuntimeError(f"{self.lost} lookups never came back")
            self._start()
            ms = int((now - began) * 1000)
            yield _attempt(request, "timeout", ms=ms, total_ms=ms)

    def results(self, requests: Iterator[tuple]) -> Iterator[tuple | None]:
        """An attempt per request, in the order they come; None now and then while there is none."""
        for _ in range(self.threads):
            self._start()
        left, numbers, ended = 0, itertools.count(), False
        while left or not ended:
            while left < self.outstanding and not ended:
                request = next(requests, None)
                ended = request is None
                if not ended:
                    self.todo.put((next(numbers), time.monotonic(), request))
                    left += 1
                    if not self.done.empty():
                        break
            try:
                _, attempt = self.done.get(timeout=min(0.05, self.timeout)) if left else (0, None)
            except queue.Empty:
                attempt = None
            if isinstance(attempt, BaseException):
                raise attempt
            if attempt is not None:
                left -= 1
                yield attempt
            for attempt in self._give_up():
                left -= 1
                yield attempt
            if attempt is None:
                yield None
        for _ in range(self.threads):
            self.todo.put(None)


def _attempt(request: tuple, outcome: str, rcode: str | None = None, wire: bytes | None = None, ms: int | None = 0,
             construct_ms: int = 0, total_ms: int = 0) -> tuple:
    name, rtype, dclass, _, server = request
    return name, rtype, dclass, f"{name}\t{dclass}\t{rtype}", outcome, rcode, ms, wire, construct_ms, total_ms, server


def _attempt_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in ATTEMPT_SCHEMA.fields]
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(cols, _ARROW_TYPES)],
                                      names=[f.name for f in ATTEMPT_SCHEMA.fields])


_ARROW_TYPES = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(),
                pa.int64(), pa.int64(), pa.string()]
