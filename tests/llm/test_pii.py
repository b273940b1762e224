"""Personal data: what holds of the whole text and the whole corpus."""

from daybook.llm import pii

DOCS = "doc_id long, text string"


def spans(spark, docs):
    """The written spans by id, each with the text it covers."""
    df = spark.createDataFrame(docs, DOCS).repartition(4)
    text = dict(docs)
    out = {}
    for x in pii.digest(pii.detect(df)).collect():
        found = [s.split(":") for s in x.spans.split(",") if s]
        out[x.doc_id] = {(kind, int(a), text[x.doc_id][int(a) : int(b)]) for kind, a, b in found}
    return out


def places(text, term, kind="removed"):
    low, at, out = text.lower(), -1, set()
    while (at := low.find(term, at + 1)) >= 0:
        out.add((kind, at, text[at : at + len(term)]))
    return out


def test_terms_go_from_the_whole_text_and_corpus(spark):
    card, far = "4111 1111 1111 1111", "x " * 60
    docs = [(i, f"Falken {card} {far}later FALKEN, Falken's and falken.") for i in range(6)]
    docs += [(10, "Only Falken here"), (11, f"😀 {far} falken {far} Falken"), (12, "Falkensee, falken2 and a.falken@x"), (13, None)]
    # told by half of its documents: a general word, and only where the card is
    docs += [(20 + i, f"Amber 5500 0000 0000 0004 {far} and Amber") for i in range(6)] + [(30 + i, "amber stone") for i in range(9)]
    docs += [(100 + i, f"Nothing {far} at all {i}") for i in range(200)]
    got = spans(spark, docs)
    for i in (0, 5):
        assert {s for s in got[i] if s[0] != "card"} == places(docs[i][1], "falken")
    assert got[10] == places("Only Falken here", "falken") and got[11] == places(docs[7][1], "falken")
    assert got[12] == set() == got[13] and got[100] == set()
    amber = next(t for d, t in docs if d == 20)
    assert {s for s in got[20] if s[0] != "card"} == places(amber, "amber", "generalised") and got[30] == set()
    clean = {x.doc_id: x.text for x in pii.sanitise(spark.createDataFrame(docs, DOCS)).collect()}
    assert "falken" not in (clean[0] + clean[10] + clean[11]).lower() and clean[30] == "amber stone"


def test_windows_hold_other_matches_and_whole_words(spark):
    card, pad = "4111 1111 1111 1111", "x " * 40
    docs = [(i, f"{pad} Falken 2024, 17, {card} in 1999 or 30: Amsel {pad}") for i in range(6)]
    docs += [(10 + i, f"a@x.co, b@x.co; Zander {pad}") for i in range(6)]
    # a word that ends with the window is whole, one that goes on isn't, and the blocks of a text don't matter
    edge = "😀" * 251 + "o " + "a@edge.org " + "y " * 28 + "Kranich "
    docs += [(20 + i, edge) for i in range(6)] + [(30 + i, edge.replace("y Kranich", "yy Kranich").replace("edge", "rand").replace("Kranich", "Drossel")) for i in range(6)]
    docs += [(40 + i, "Lerche " + "y " * 28 + " 1.2.3.4") for i in range(6)] + [(50 + i, "Sperber " + "y " * 28 + " 8.8.8.8") for i in range(6)]
    docs += [(100 + i, f"Nothing {pad} at all {i}") for i in range(200)]
    got = spans(spark, docs)
    marked = {term for found in got.values() for kind, _, term in found if kind in ("generalised", "removed")}
    assert marked == {"Falken", "Amsel", "Zander", "Kranich", "Lerche"}
    assert got[20] == {("email", 253, "a@edge.org"), *places(edge, "kranich")}


def test_terms_of_many_entities_and_documents_of_many(spark):
    """A general term that ten cards share, one card's term, and documents that hold one of the cards or all."""
    far = "x " * 60
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009", "6011 0000 0000 0004"]
    docs, i = [], 0
    for card in cards:
        for _ in range(5):
            docs.append((i, f"Amber {card} {far} and Amber"))
            i += 1
    docs += [(100 + j, f"Coral {cards[0]} {far} Amber, coral") for j in range(5)]
    docs += [(200, far.join(cards) + far + " amber coral"), (201, f"a@b.co 1.2.3.4 {far} amber"), (202, "amber coral"), (None, f"{cards[1]} {far} AMBER coral")]
    docs += [(300 + j, "amber coral stone") for j in range(12)] + [(400 + j, f"Nothing at all {j}") for j in range(4000)]
    df = spark.createDataFrame(docs, DOCS).repartition(4)
    kinds = pii.disclosing(df, pii.entities(df)).collect()
    # told by several entities, and by one, both only in general
    assert {r.term: sum(x.term == r.term for x in kinds) for r in kinds} == {"amber": 4, "coral": 1}
    assert {r.kind for r in kinds} == {pii.KINDS.index("generalised")}
    got = spans(spark, docs)
    text = dict(docs)
    marked = {d: {s for s in found if s[0] == "generalised"} for d, found in got.items()}
    assert marked[0] == places(text[0], "amber", "generalised") and marked[19] == places(text[19], "amber", "generalised")
    both = lambda d: places(text[d], "amber", "generalised") | places(text[d], "coral", "generalised")
    assert marked[100] == both(100) and marked[200] == both(200)
    assert marked[None] == places(text[None], "amber", "generalised")
    assert not any(marked[d] for d in (201, 202, 300, 400))
