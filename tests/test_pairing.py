import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from scholion.operators import pairing


def brute(lefts, rights, least):
    def norm(n):
        return " ".join("".join(c if c.isalnum() else " " for c in n.rsplit(".", 1)[0].lower().removesuffix("_content_list")).split())

    def ratio(a, b):
        return max(SequenceMatcher(None, a, b).ratio(),
                   SequenceMatcher(None, " ".join(sorted(a.split())), " ".join(sorted(b.split()))).ratio())

    keys = {n: norm(n) for n in lefts + rights}
    used, out = set(), set()
    for a in lefts:
        same = [b for b in rights if keys[b] == keys[a]]
        if len(same) == 1 and sum(keys[x] == keys[a] for x in lefts) == 1:
            out.add((a, same[0], "exact_normalized"))
            used |= {a, same[0]}
    scored = sorted((-ratio(keys[a], keys[b]), a, b) for a in lefts for b in rights
                    if a not in used and b not in used and ratio(keys[a], keys[b]) >= least)
    for _, a, b in scored:
        if a not in used and b not in used:
            out.add((a, b, "fuzzy"))
            used |= {a, b}
    return out


def test_pairing_equals_going_down_the_sorted_list(spark):
    rng = random.Random(11)
    words = ["poly", "imide", "film", "aerogel", "carbon", "nano", "ink", "gel", "x", "12"]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 5))) for _ in range(40)]
    base += [base[0]] * 3

    def change(name):
        i = rng.randrange(len(name))
        return name[:i] + rng.choice("abz ") + name[i + 1:]

    lefts = sorted({f"{n}{'_' * k}.md" for k, n in enumerate(base)})
    rights = sorted({f"{change(n) if k % 3 else n.replace(' ', '-')}{'-' * (k % 4)}_content_list.json" for k, n in enumerate(base)})
    left = spark.createDataFrame([(n,) for n in lefts], "name string")
    right = spark.createDataFrame([(n,) for n in rights], "name string")
    rows = pairing.pairing_report(left, right).collect()
    found = {(r.md_name, r.content_name, r.match_type) for r in rows if r.md_name and r.content_name}
    assert found == brute(lefts, rights, 0.85)
    assert {r.md_name for r in rows if r.md_name} == set(lefts)
    assert {r.content_name for r in rows if r.content_name} == set(rights)


def test_names_with_a_common_beginning_leave_few_candidates(spark):
    import hashlib
    from difflib import SequenceMatcher

    from scholion.operators import pairing

    codes = [hashlib.md5(str(i).encode()).hexdigest() for i in range(150)]
    near = [c[:k] + "_x" for c, k in zip(codes[:60], [17, 16, 15] * 20)]
    left = [f"Paper_{c[:20]}.md" for c in codes] + ["a.md", "ab cd.md"]
    right = [f"paper-{n}_content_list.json" for n in near + [c[:20] for c in codes[60:90]]] + ["a_content_list.json", "cd-ab_content_list.json"]
    sides = [pairing.normalize_keys(spark.createDataFrame([(n,) for n in names], "name string"), side)
             for names, side in ((left, "left"), (right, "right"))]
    keys = [[(r.normalized, r.token_sorted) for r in s.collect()] for s in sides]
    wanted = {(a, b) for a, ta in keys[0] for b, tb in keys[1]
              if max(SequenceMatcher(None, a, b).ratio(), SequenceMatcher(None, ta, tb).ratio()) >= 0.85}
    found = {(r.left_key, r.right_key) for r in pairing.candidate_keys(*sides, 0.85).collect()}
    assert wanted <= found
    # the grams that all names share bring nobody together
    assert len(found) < 2 * len(wanted)


def common_characters(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_chunks_bring_all_similar_texts_together(spark):
    rng = random.Random(5)

    def change(text):
        for _ in range(rng.randint(0, 1 + len(text) // 6)):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["", rng.choice("abé ")]) + text[at + rng.randint(0, 1):]
        return text

    lefts = {"".join(rng.choices("abcé ", k=rng.choice([1, 2, 3, 4, 5, 7, 9, 14, 26, 60]))) for _ in range(70)}
    lefts |= {"report of the year " + t for t in list(lefts)[:20]}
    rights = {change(t) for t in sorted(lefts)} | {"".join(rng.choices("abc", k=rng.randint(1, 30))) for _ in range(30)}
    sides = [spark.createDataFrame([(t,) for t in sorted(texts)], "text string") for texts in (lefts, rights)]
    for least in (0.4, 0.85):
        wanted = {(a, b) for a in lefts for b in rights if a and b and common_characters(a, b) * 2 >= least * (len(a) + len(b)) - 1e-9}
        found = {(r.left_text, r.right_text) for r in pairing.similar_texts(*sides, least).collect()}
        assert wanted <= found
    # nothing on one side, nothing in common lengths
    assert pairing.similar_texts(sides[0].where("false"), sides[1], 0.85).count() == 0


def test_unlike_names_hardly_meet(spark):
    codes = ["paper " + "".join(random.Random(i).choices("0123456789abcdef", k=20)) for i in range(1200)]
    left, right = (spark.createDataFrame([(c,) for c in half], "text string") for half in (codes[:600], codes[600:]))
    kinds = pairing.chunk_kinds(left, right, 0.85).collect()
    assert [(k["size"], k["many"]) for k in kinds] == [(5, 4)]
    chunks = pairing.chunk_rows(left.withColumn("many", F.lit(4)), 5, pairing.gram_counts(right, 5))
    # chunks keep away from what all names begin with
    assert chunks.agg(F.min("at")).first()[0] >= 4
    assert chunks.select("id", "at").distinct().count() == 600 * 4
    # of all pairs, before the places and the outlines are looked at
    assert chunks.join(pairing.gram_rows(right, 5), "key").count() < 600 * 600 / 50
    bound = pairing.Bound(F.length("a.text"), F.length("b.text"), 0.85)
    pairs = pairing.outlined(left).alias("a").crossJoin(pairing.outlined(right).alias("b"))
    assert pairs.where(bound.alike("a", "b")).count() < 600 * 600 / 100
