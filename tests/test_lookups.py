"""Caller-supplied lookups: a window over batches, deadlines, back-pressure."""

import itertools
import threading
import time

import pytest

from rrspark.operators.resolve import LookupWindow, resolve_with

KEY = "name string, type string, dclass string"


def request(name, ok=True):
    return name, "A", "IN", ok, None


def test_one_stalled_lookup_delays_one_row():
    stall = threading.Event()

    def lookup(name, rtype, dclass):
        if name == "stalled.":
            stall.wait(30)
        return "NOERROR", name.encode()

    began = time.monotonic()
    rows, at = [], {}
    for r in LookupWindow(lookup, 4, 1.0, 50).results(iter([request("stalled.")] + [request(f"n{i}.") for i in range(500)])):
        if r is not None:
            rows.append(r)
            at[r[0]] = time.monotonic() - began
    stall.set()
    assert len(rows) == 501 and rows[-1][0] == "stalled." and rows[-1][4] == "timeout" and rows[-1][6] >= 1000
    assert all(r[4] == "ok" for r in rows[:-1]) and max(at[r[0]] for r in rows[:-1]) < 1.0 < at["stalled."] < 3


def test_stalled_threads_are_replaced():
    stall = threading.Event()

    def lookup(name, rtype, dclass):
        if name.startswith("stalled"):
            stall.wait(30)
        return "NOERROR", b""

    asked = [request(f"stalled{i}.") for i in range(6)] + [request(f"n{i}.") for i in range(50)]
    rows = [r for r in LookupWindow(lookup, 2, 0.2, 100).results(iter(asked)) if r]
    stall.set()
    assert sorted(r[4] for r in rows) == ["ok"] * 50 + ["timeout"] * 6


def test_a_late_answer_does_not_count_twice():
    def lookup(name, rtype, dclass):
        time.sleep(0.5 if name == "late." else 0)
        return "NOERROR", b""

    def asked():
        yield request("late.")
        time.sleep(0.8)  # the late answer comes after its deadline, while more is asked
        yield from (request(f"n{i}.") for i in range(20))

    rows = [r for r in LookupWindow(lookup, 2, 0.2, 100).results(asked()) if r]
    assert len(rows) == 21 and sorted(r[4] for r in rows) == ["ok"] * 20 + ["timeout"]


def test_requests_are_taken_as_answers_go_out():
    taken, answered, most = itertools.count(), 0, 0
    last = -1

    def asked():
        nonlocal last
        for i in range(300):
            last = next(taken)
            yield request(f"n{i}.")

    def lookup(name, rtype, dclass):
        time.sleep(0.002)
        return "NOERROR", b""

    for r in LookupWindow(lookup, 5, 5.0, 10).results(asked()):
        if r is not None:
            answered += 1
            most = max(most, last + 1 - answered + 1)
    assert answered == 300 and most <= 11


def test_errors_of_the_lookup_fail_the_task():
    def lookup(name, rtype, dclass):
        raise KeyError("a bug")

    with pytest.raises(KeyError):
        list(LookupWindow(lookup, 2, 1.0, 10).results(iter([request("a.")])))


def test_outcomes_through_spark(spark):
    def factory(timeout):
        def lookup(name, rtype, dclass):
            if name == "slow.":
                time.sleep(5)
            if name == "refused.":
                raise ConnectionRefusedError
            if name == "late.":
                raise TimeoutError
            return ("NXDOMAIN", b"x") if name == "none." else ("NOERROR", b"y")
        return lookup

    names = ["slow.", "refused.", "late.", "none.", "bad..", *(f"n{i}." for i in range(3000))]
    reqs = spark.createDataFrame([(n, "A", "IN") for n in names], KEY)
    rows = {r["name"]: r for r in resolve_with(reqs, factory, threads=8, timeout=0.5, partitions=2, outstanding=20).collect()}
    assert len(rows) == len(names)
    assert {n: rows[n]["outcome"] for n in names[:5]} == {
        "slow.": "timeout", "refused.": "failure", "late.": "timeout", "none.": "ok", "bad..": "parse_failure"}
    assert rows["none."]["rcode"] == "NXDOMAIN" and all(rows[n]["outcome"] == "ok" for n in names[5:])
    assert all(r["question"] == f"{n}\tIN\tA" for n, r in rows.items())
    assert resolve_with(reqs.where("false"), factory).count() == 0
