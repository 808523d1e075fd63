"""Random swimmers rendered as sheet text must parse back exactly."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lapline.operators.parse import parse_sheets

UP = st.text("ABCDEFGHIJKLMNOPQRSTUVWXYZ", min_size=2, max_size=6)
LOW = st.text("abcdefghijklmnopqrstuvwxyz", min_size=1, max_size=6)
LAST = st.lists(st.one_of(UP, st.builds(lambda a, b: f"{a}'{b}", UP, UP), st.builds(lambda a, b: f"{a}-{b}", UP, UP)),
                min_size=1, max_size=3)
FIRST = st.lists(st.one_of(st.builds(lambda a, b: a[0] + b, UP, LOW),
                           st.builds(lambda a, b, c: f"{a[0]}{b}-{a[1]}{c}", UP, LOW, LOW)), min_size=1, max_size=2)
CODE = st.one_of(st.text("ABCDEFGHIJKLMNOPQRSTUVWXYZ", min_size=2, max_size=8),
                 st.builds(lambda a, b: f"{a}-{b}", st.text("ABCDEFGH", min_size=2, max_size=4),
                           st.text("ABCDEFGH", min_size=2, max_size=3)))
GAP = st.sampled_from([" ", "  ", "\t", "  "])


def fmt(cs):
    return f"{cs // 6000}:{cs % 6000 // 100:02d}.{cs % 100:02d}" if cs >= 6000 else f"{cs // 100:02d}.{cs % 100:02d}"


SWIMMER = st.fixed_dictionaries({
    "last": LAST, "first": FIRST, "code": CODE, "gap": GAP,
    "reaction": st.one_of(st.none(), st.integers(50, 99)),
    "final": st.integers(1000, 59999),
    "splits": st.lists(st.one_of(st.none(), st.integers(1000, 59999)), min_size=7, max_size=7),
    "junk": st.sampled_from(["", " WR", " Q", " +1.20"]),
})


def render(heats):
    lines, expected = ["Results", "Some header text"], []
    for h, swimmers in enumerate(heats):
        label = f"Final {'ABC'[h]}"
        lines += [f"{label} Event 105", "Rank Lane Name NOC R.T. Time"]
        for rank, s in enumerate(swimmers, start=1):
            g = s["gap"]
            parts = [str(rank), str(rank % 8 + 1), *s["last"], *s["first"], s["code"]]
            if s["reaction"] is not None:
                parts.append(f"0.{s['reaction']}")
            parts.append(fmt(s["final"]))
            lines.append(g.join(parts) + s["junk"])
            entries = [f"{d}m ({rank}) {fmt(t)}" for d, t in zip(range(50, 400, 50), s["splits"]) if t is not None]
            if entries:
                lines.append(" ".join(entries))
            splits = tuple(fmt(t) if t is not None else None for t in s["splits"])
            expected.append((label, rank, rank % 8 + 1, " ".join(s["last"]), " ".join(s["first"]),
                             s["reaction"] / 100 if s["reaction"] is not None else None, *splits, fmt(s["final"])))
    return "\n".join(lines) + "\n", expected


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(SWIMMER, min_size=1, max_size=5), min_size=1, max_size=3))
def test_render_parse_round_trip(spark, heats):
    text, expected = render(heats)
    df = spark.createDataFrame([("doc", text)], "Link string, text string")
    got = [tuple(r)[1:] for r in parse_sheets(df).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
