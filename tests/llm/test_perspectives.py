from collections import defaultdict

from conftest import rows

from dealcast.llm import perspectives


def brute(data, block=256):
    convs = defaultdict(list)
    for conv, turn, role, text in data:
        role, text = (role or "unknown") if role is not None else "unknown", text or ""
        convs[conv].append(((turn is not None, turn or 0), role.replace("<|", "< |"), text.replace("<|", "< |")))
    out = []
    for conv, turns in convs.items():
        turns.sort()
        for who in {r for _, r, _ in turns if r != "system"}:
            for b in range(0, len(turns), block):
                text, spans = "", []
                for _, role, said in turns[b:b + block]:
                    text += "<|assistant|>\n" if role == who else "<|system|>\n" if role == "system" else f"<|user name={role}|>\n"
                    at = len(text)
                    text += said + "<|end|>\n"
                    if role == who:
                        spans.append(f"{at}-{len(text) - 1}")
                out.append((conv, who, b // block, len(turns[b:b + block]), text, ",".join(spans)))
    return sorted(out, key=str)


def test_edge_cases(spark):
    data = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|> é"), (1, 2, "bob", None), (1, 2, "ann", "🙂"), (1, None, "cy", "first"),
            (None, 1, "ann", "x"), (None, 1, None, "y"), (2, 0, "system", "alone"), (3, 5, "a<|b", ""), (3, 5, "a<|b", ""), (3, 5, "a<|b", "")]
    data += [(4, t // 3, "ann" if t % 2 else "bob", f"t{t}") for t in range(40)] + [(5, 1, "ann", "same")] * 30 + [(5, 2, "bob", "long " * 20_000)]
    d = spark.createDataFrame([(*x, "s", 1, "k") for x in data], "conv_id long, turn long, role string, text string, rendered string, n int, key string")
    for block, slices in ((256, 4), (8, 3), (1, 1)):
        assert rows(perspectives.digest(perspectives.perspectives(d, block=block, slices=slices))) == brute(data, block)
    assert perspectives.perspectives(d.limit(0)).count() == 0


def test_the_mask_marks_what_the_assistant_says(spark):
    d = spark.createDataFrame([(1, 0, "ann", "one"), (1, 1, "bob", "two"), (1, 2, "ann", "three")], "conv_id long, turn long, role string, text string")
    got = {r.perspective: [r.rendered[s.start:s.end] for s in r.mask] for r in perspectives.perspectives(d).collect()}
    assert got == {"ann": ["one<|end|>", "three<|end|>"], "bob": ["two<|end|>"]}


def test_no_python_in_the_plan(spark, docs):
    d = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = perspectives.perspectives(d)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
