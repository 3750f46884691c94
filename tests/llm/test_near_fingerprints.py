from carestrata.llm import shingles
from carestrata.runtime import materialise


def test_close_fingerprints_are_links_where_shingles_confirm_them(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, text, 0b1000),
        (2, text + " more", 0b1000),  # the same fingerprint
        (3, "some " + text, 0b1011),  # two bits away
        (4, "quite another text of five words and more", 0b1000),  # the same fingerprint, nothing in common
        (5, text + " else", 1 << 40 | 0b0111),  # similar, but too far away
    ]
    nodes = materialise(spark.createDataFrame(rows, "node long, text string, fp long"), "t")
    links = shingles.near_fingerprints(nodes.select("node", "fp"), nodes.select("node", "text"), 5)
    assert sorted(tuple(sorted(r)) for r in links.collect()) == [(1, 2), (1, 3)]
    every = shingles.near_links(nodes.select("node", "text"), nodes.select("node", "fp"), 5).collect()
    assert {x for r in every for x in r} == {1, 2, 3, 5}
