import random

from blotterflow.llm.chat_format import PART, rotate_perspectives

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """(conversation, perspective) -> (text, masked parts)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = {(t, r or "", x or "") for c, t, r, x in rows if c == conv}
        own = sorted(own, key=lambda t: (-1 if t[0] is None else t[0] // PART, -1 if t[0] is None else t[0], t[1], t[2]))
        for who in {r for _, r, _ in own if r != "system"}:
            text, masked = "", []
            for _, role, x in own:
                text += "<|assistant|>\n" if role == who else "<|system|>\n" if role == "system" else f"<|user|> {role}:\n"
                if role == who:
                    masked.append(x + "<|end|>")
                text += x + "<|end|>\n"
            out[conv, who] = text, masked
    return out


def joined(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.part)):
        text, masked = out.setdefault((r.conv_id, r.perspective), ("", []))
        assert r.begin == len(text)
        masked += [r.rendered[a:b] for a, b in r.spans]
        out[r.conv_id, r.perspective] = text + r.rendered, masked
    return out


def test_as_brute_force(spark):
    pick = random.Random(1)
    names = ["ann", "bob", "system", None, "cy é", "assistant", "user"]
    rows = [
        (pick.choice([1, 2, 3, None]), pick.choice([None, *range(12), 300, 301]), pick.choice(names), pick.choice([None, "", "hi", "é😀 there\n"]))
        for _ in range(200)
    ]
    assert joined(rotate_perspectives(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_long_conversation_is_cut_in_parts(spark):
    rows = [(7, i, ("ann", "bob", "system")[i % 3], f"t{i}") for i in range(3 * PART + 5)]
    out = rotate_perspectives(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert out.where(f"n_turns > {PART}").count() == 0 and out.count() == 8
    assert joined(out) == brute(rows)


def test_edges(spark):
    assert rotate_perspectives(spark.createDataFrame([], SCHEMA)).count() == 0
    system = [(1, 0, "system", "only")]
    assert rotate_perspectives(spark.createDataFrame(system, SCHEMA)).count() == 0
    rows = [(1, 0, "a", "x" * 100_000, 1, "p"), (1, 0, "a", "x" * 100_000, 2, "p")]
    out = rotate_perspectives(spark.createDataFrame(rows, SCHEMA + ", part int, perspective string"))
    assert joined(out) == brute([r[:4] for r in rows])


def test_parts_are_bounded_whatever_the_turn_numbers(spark):
    n = 3 * PART + 9
    rows = [(None, i % 3, ("ann", "bob")[i % 2], f"x{i}") for i in range(n)]
    rows += [(1, None, "ann", f"y{i}") for i in range(n)] + [(2, 5, "ann", "same beginning " * 9 + str(i)) for i in range(n)]
    rows += [(3, i, "ann", "z") for i in (-300, -1, 4, None)] + [(3, -1, "ann", "z")] * 500
    out = rotate_perspectives(spark.createDataFrame(rows, SCHEMA).repartition(4)).cache()
    assert out.where(f"n_turns > {PART}").count() == 0 and out.count() == 2 * 4 + 4 + 4 + 1
    got = joined(out)
    assert len(got[3, "ann"][1]) == 4
    want = brute([r for r in rows if r[0] != 3])
    assert {k: v for k, v in got.items() if k[0] != 3} == want
