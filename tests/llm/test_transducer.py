"""The transducer against a sorted list."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlark.llm.transducer import Transducer

STRINGS = st.binary(max_size=6) | st.lists(st.sampled_from([b"ab", b"b", b"\xff"]), max_size=5).map(b"".join)


@settings(max_examples=300, deadline=None)
@given(st.sets(STRINGS, max_size=60), st.lists(STRINGS, max_size=40))
def test_ordinals_are_places_in_the_sorted_list(kept, others):
    ordered = sorted(kept)
    machine = Transducer.unpacked(Transducer.build(ordered).packed())
    probes = ordered + others
    assert machine.ordinals(probes).tolist() == [ordered.index(p) if p in kept else -1 for p in probes]
    assert [machine.spelled(n) for n in range(len(ordered))] == ordered


def test_equal_ends_share_their_states():
    stems = [bytes([a, b]) for a in b"bcdfg" for b in b"aeiou"]
    machine = Transducer.build(sorted(s + end for s in stems for end in (b"", b"tion", b"tions")))
    # all stems lead to one machine of endings: 1 root, 1 state after a first letter, 6 for "", "t" .. "tions"
    assert len(machine.final) == 8
    assert machine.size == 75


def test_long_strings_and_wrong_order():
    long = b"a" * 50_000
    machine = Transducer.build([long, long + b"b"])
    assert machine.ordinals([long, long + b"b", long[:-1], b""]).tolist() == [0, 1, -1, -1]
    for wrong in ([b"b", b"a"], [b"a", b"a"]):
        try:
            Transducer.build(wrong)
        except ValueError:
            continue
        raise AssertionError(wrong)
