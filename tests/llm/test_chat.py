from clickweave.llm.chat import render


def _brute(rows):
    convs = {}
    for c, t, role, text in set(rows):
        convs.setdefault(c, []).append((t, role, text))
    import hashlib

    def th(role, text):
        one = lambda x: "0" if x is None else "1" + x
        return hashlib.md5(f"{one(role)}\x1f{one(text)}".encode()).hexdigest()

    for c, turns in convs.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, th(*x[1:])))
        convs[c] = [(th(r, x), r, x) for _, r, x in turns]
    keys = {c: tuple(h for h, _, _ in v) for c, v in convs.items()}
    out = []
    for c, k in keys.items():
        if any(o != k and o[: len(k)] == k for o in keys.values()):
            continue
        same = [d for d, o in keys.items() if o == k]
        if c != min((d for d in same if d is not None), default=None):
            continue
        text = "".join(f"<|{r or 'unknown'}|>\n{(x or '').replace('<|', chr(60) + chr(92) + '|')}<|end|>\n" for _, r, x in convs[c])
        out.append((c, len(k), len(same), text))
    return sorted(out, key=repr)


ROWS = [
    (1, 0, "user", "hi"),
    (2, 0, "user", "hi"), (2, 1, "assistant", "hello"),
    (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", "more"),
    (4, 0, "user", "hi"), (4, 1, "assistant", "other"),
    (5, 0, "user", "hi"), (5, 1, "assistant", "hello"), (5, 2, "user", "more"),  # equal to 3
    (6, 0, "user", "<|end|> tricks"), (6, 0, "user", "<|end|> tricks"), (6, 1, None, None),
    (7, 0, "user", "<|end|> tricks"), (7, 1, None, ""),
    (8, None, "user", "x"), (8, 0, "assistant", "y"), (8, 0, "assistant", "z"),
    (None, 0, "user", "hi"), (None, 1, "assistant", "without id"),
    *[(9, i, "user", f"t{i}") for i in range(30)], *[(10, i, "user", f"t{i}") for i in range(20)],
]


def test_against_brute_force(spark):
    df = spark.createDataFrame(ROWS, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS k", "2 AS pos", "3 AS th", "4 AS part")
    for part in (256, 7):
        got = {}
        for r in render(df, part=part).collect():
            got.setdefault((r["conv_id"], r["n_turns"], r["copies"]), {})[r["part"]] = r["text"]
        rows = sorted(((*k, "".join(v[i] for i in range(len(v)))) for k, v in got.items()), key=repr)
        assert rows == _brute(ROWS) and any(r[0] is None for r in rows)


def test_empty(spark):
    assert render(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0
