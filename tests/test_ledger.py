"""Runs that are retried, resumed and kept apart."""

from __future__ import annotations

import pytest

from envhealth.plans.ledger import Busy, Ledger, run_stages


class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        self.now += 1
        return self.now


@pytest.fixture
def ledger(spark, tmp_path):
    clock = Clock()
    return lambda **options: Ledger(spark, str(tmp_path / "ledger"), "2024-01-01", clock=clock, **options)


def stages(done, failures=()):
    """Two first stages and one that needs both; `failures` are the stages that fail, in order."""
    left = list(failures)

    def work(name):
        def run():
            done.append(name)
            if name in left:
                left.remove(name)
                raise RuntimeError(f"{name} lost")
            return {name: len(done)}

        return run

    return {"a": ((), work("a")), "b": ((), work("b")), "c": (("a", "b"), work("c"))}


def test_a_stage_that_fails_once_ends_green(ledger):
    done = []
    report = run_stages(ledger(), stages(done, ["c"]))
    assert sorted(done) == ["a", "b", "c", "c"] and set(report) == {"a", "b", "c"}
    states = [(r["stage"], r["attempt"], r["state"]) for r in ledger().events().where("stage = 'c'").orderBy("at").collect()]
    assert states == [("c", 1, "failed"), ("c", 2, "done")]


def test_after_a_crash_only_the_rest_runs(ledger):
    done = []
    with pytest.raises(RuntimeError, match="b lost"):
        run_stages(ledger(), stages(done, ["b", "b"]))
    assert sorted(done) == ["a", "b", "b"]
    first, done = done, []
    report = run_stages(ledger(), stages(done))
    assert done == ["b", "c"] and report["a"] == {"a": first.index("a") + 1}["a"]
    assert set(report) == {"a", "b", "c"}
    done = []
    assert run_stages(ledger(), stages(done)) == report and done == []
    run_stages(ledger(), stages(done), again=True)
    assert sorted(done) == ["a", "b", "c"]


def test_a_stage_runs_again_when_what_it_needs_did(ledger):
    done = []
    run_stages(ledger(), stages(done))
    ledger().note("a", 1, "failed", "found wrong later")
    done.clear()
    run_stages(ledger(), stages(done))
    assert done == ["a", "c"]


def test_two_runs_of_a_date_are_kept_apart(ledger):
    holder = ledger()
    holder.claim()
    with pytest.raises(Busy):
        run_stages(ledger(), stages([]))
    holder.release()
    run_stages(ledger(), stages([]))
    crashed = ledger()
    crashed.claim()
    with pytest.raises(Busy):
        ledger().claim()
    late = ledger(lease=5.0)
    late.clock.now += 10
    late.claim()
    assert late.holder() == late.owner


def test_of_two_that_claim_at_once_the_later_gives_way(ledger):
    first, second = ledger(), ledger()
    first.note("claim", 0, "claimed")
    with pytest.raises(Busy):
        second.claim()
    assert first.holder() == first.owner


def test_stages_that_cannot_start(ledger):
    with pytest.raises(ValueError, match="need"):
        run_stages(ledger(), {"a": (("b",), dict)})
