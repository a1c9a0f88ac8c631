import random
from collections import Counter

from cloudtally.llm import line_runs


def brute(docs):
    """``docs``: (id, text) in table order. Lines of windows that stand earlier, found one by one."""
    filled = {}
    for place, (doc_id, text) in enumerate(docs):
        lines = (text or "").split("\n")
        filled[place] = lines, [i for i, line in enumerate(lines) if line.strip(" \t\n\r\x0b\x0c")]
    order = sorted(filled, key=lambda p: (docs[p][0] is not None, docs[p][0] or 0, p))
    first, out = {}, {}
    for place in order:
        lines, numbers = filled[place]
        text = [lines[i] for i in numbers]
        gone = set()
        for at in range(len(text)):
            length, size = 0, 0
            while at + size < len(text) and size < 3 and length < 200:
                length, size = length + len(text[at + size].encode()), size + 1
            if size < 3 and length < 200:
                continue
            window = tuple(text[at : at + size])
            if window not in first:
                first[window] = text, at
                continue
            source, there = first[window]
            low, high = 0, size
            while low > -2 and at + low > 0 and there + low > 0 and text[at + low - 1] == source[there + low - 1]:
                low -= 1
            while high < size + 2 and at + high < len(text) and there + high < len(source) and text[at + high] == source[there + high]:
                high += 1
            gone.update(range(at + low, at + high))
        kept = [line for i, line in enumerate(lines) if i not in {numbers[p] for p in gone}]
        out[place] = (docs[place][0], len(lines), len(gone), sum(p - 1 not in gone for p in gone), "\n".join(kept))
    return out


def check(df):
    docs = [(r.doc_id, r.text) for r in df.collect()]
    got = Counter(map(tuple, line_runs.deduplicated(df).collect()))
    assert got == Counter(brute(docs).values())


def test_runs(spark, tmp_path):
    rng = random.Random(9)
    pool = [f"line {i}" for i in range(12)] + ["", " \t", "same"]
    docs = [(rng.choice([i, i, i, 3, None]), "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))) for i in range(80)]
    docs += [(200, docs[4][1]), (201, "\n\n" + docs[4][1] + "\nx"), (202, "a\nb\nc\na\nb\nc\na\nb"), (203, None)]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    check(spark.read.parquet(f"{tmp_path}/docs"))


def test_long_lines_go_on_their_own(spark, docs):
    """One or two lines of 200 bytes together are a run; the short lines around it go with it."""
    long = " ".join(f"w{i}" for i in range(60))
    half = " ".join(f"h{i}" for i in range(30))
    texts = [
        f"intro\na\n{long}\nb\nend", long, f"a\n{long}\nb", f"{half}\n{half} x", f"y\n{half}\n{half} x\nz", half,
        f"{half}\nother", "a\nb", f"b\n{long}",
    ]
    df = docs(texts)
    check(df)
    left = {r.doc_id: r.kept for r in line_runs.deduplicated(df).collect()}
    assert [left[i] for i in range(9)] == [texts[0], "", "", texts[3], "y\nz", half, texts[6], "a\nb", "b"]


def test_no_line_goes_with_all_its_copies(spark):
    rng = random.Random(4)
    pool = [f"line {i}" for i in range(6)] + [" ".join(["long"] * n) for n in (26, 30, 55)]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(df)
    kept = {line for r in line_runs.deduplicated(df).collect() for line in r.kept.split("\n")}
    assert {line for t in texts for line in t.split("\n")} <= kept


def test_odd_documents(spark, odd_docs, no_docs):
    check(odd_docs)
    assert line_runs.deduplicated(no_docs).count() == 0


def test_no_python(spark, odd_docs):
    plan = line_runs.deduplicated(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
