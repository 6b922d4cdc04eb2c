import random
import re

from support import make_docs, make_table  # noqa: F401

import duckdb

from trolley.llm import decontam
from trolley.llm.decontam import contained_items
from trolley.llm.queries import ORACLE


def brute(docs, items, share=0.8):
    words = lambda text: re.findall(r"\w+", (text or "").lower())
    out = {}
    for item, text in items:
        own = words(text)
        n = min(5, len(own))
        shingles = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for doc, whole in docs:
            held = words(whole)
            common = shingles & {tuple(held[i : i + n]) for i in range(len(held) - n + 1)}
            if shingles and len(common) >= share * len(shingles):
                value = len(common) / len(shingles)
                out[doc, item] = max(value, out.get((doc, item), 0))
    return out


def cases():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    text = lambda n: [word() for _ in range(n)]
    items = [(i, text(rng.choice([1, 3, 5, 6, 14, 40, 59, 300]))) for i in range(40)]
    docs = []
    for i in range(80):
        own = text(rng.choice([0, 3, 50, 800, 6000]))
        for _ in range(i % 3):
            _, passage = rng.choice(items)
            passage = list(passage)
            if i % 2 and len(passage) > 10:
                passage[rng.randrange(len(passage))] = "edited"
            at = rng.randint(0, len(own))
            own[at:at] = passage
        docs.append((i, own))
    # An item in pieces all over a document counts as well.
    scattered = next(words for _, words in items if len(words) == 40)
    pieces = []
    for start in range(0, 36, 4):
        pieces += text(300) + scattered[start : start + 8]
    docs.append((200, pieces))
    say = lambda rows: [(i, " ".join(w)) for i, w in rows]
    docs, items = say(docs), say(items)
    docs += [(300, None), (301, ""), (302, items[5][1].upper() + "!"), (None, items[6][1]), (7, items[7][1])]
    items += [(90, None), (91, ""), (92, "..."), (None, items[8][1]), (93, items[5][1]), (94, "x " * 20)]
    docs += [(303, "y x x x x x x y")]
    return docs, items


def test_equals_brute_force(make_docs, make_table):
    docs, items = cases()
    table = make_table("item_id bigint, text string", *items)
    found = decontam.contained_items(make_docs(*docs, parts=4), table)
    expected = brute(docs, items)
    assert len(expected) > 60
    assert {(r.doc_id, r.item_id): r.containment for r in found.collect()} == expected


def test_blocks_of_items_give_the_same(make_docs, make_table, monkeypatch):
    docs, items = cases()
    table = make_table("item_id bigint, text string", *items)
    monkeypatch.setattr(decontam.item_blocks, "__defaults__", (500,))
    frame = make_docs(*docs)
    found = decontam.contained_items(frame, table)
    expected = brute(docs, items)
    assert {(r.doc_id, r.item_id): r.containment for r in found.collect()} == expected
    kept = decontam.without_contaminated(frame, table)
    texts = {text for doc, text in docs if not brute([(doc, text)], items)}
    assert {row.text for row in kept.collect()} == texts
    assert kept.columns == frame.columns


def test_empty_tables(make_docs, make_table):
    items = make_table("item_id bigint, text string", (1, "one two three four five six"))
    docs = make_docs((1, "zero one two three four five six seven"), (2, None))
    assert decontam.contained_items(docs, items).count() == 1
    assert decontam.contained_items(docs.limit(0), items).count() == 0
    assert decontam.contained_items(docs, items.limit(0)).count() == 0
    assert decontam.without_contaminated(docs, items.limit(0)).count() == 2
    assert [row.doc_id for row in decontam.without_contaminated(docs, items).collect()] == [2]


def test_the_sql_has_short_items_too(make_docs, make_table, tmp_path):
    docs = make_docs(
        (1, "red fox today"), (2, "a red fox today and more words"), (3, "red fox"), (4, ""),
        (5, "one two three four five six"), (6, None), (7, "fox"),
    )
    items = [(7, "red fox today"), (8, "fox"), (9, "one two three four five"), (10, ""),
             (11, "one two three four"), (12, "one two three four five six")]
    benchmark = make_table("item_id bigint, text string", *items)
    found = {tuple(row) for row in contained_items(docs, benchmark).collect()}
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    with duckdb.connect() as database:
        for name in ("documents", "benchmark"):
            database.execute(
                f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'"
            )
        rows = database.execute(ORACLE["op5_decontamination"]).fetchall()
    assert {tuple(row) for row in rows} == found
    assert {(1, 7, 1.0), (2, 7, 1.0), (7, 8, 1.0), (5, 9, 1.0), (5, 11, 1.0)} <= found
