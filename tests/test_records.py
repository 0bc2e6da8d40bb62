"""Record-in, record-out cases, rewritten from the shapes that FIXTURES.md lists."""

import gc
import hashlib
import os
import random
import re
import time

import pytest
from propweave import functions as fn
from propweave import model
from propweave.operators import collectors, components, enrich, matching, text
from propweave.plans import lineage, program
from propweave.plans.program import parse
from propweave.sources import library, sinks, tables
from propweave.sources import text as lines
from pyspark.sql import functions as F


def props(spark, *rows):
    """(id, name, value) or (id, ent_no, ent, name, value) in order."""
    full = [(r[0], i, *((None, None, r[1], r[2]) if len(r) == 3 else r[1:])) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, model.PROPS_SCHEMA)


def emitted(df):
    return sorted((r.id, r.name, r.value) for r in df.collect())


def rules(body, maps=""):
    return parse(f"<metamorph><rules>{body}</rules><maps>{maps}</maps></metamorph>")


def test_isbn_key_with_edition_and_volume(spark):
    body = """<combine name="key" value="${i}-${v}-${e}"><data source="isbn" name="i"><buffer/></data>
      <choose name="v"><data source="volume"><regexp match="\\d+"/></data><data source="_id"><constant value="X"/></data></choose>
      <choose name="e"><data source="edition"><regexp match="\\d+"/></data><data source="_id"><constant value="X"/></data></choose></combine>"""
    one = props(spark, ("r7", "edition", "3rd, revised"), ("r7", "isbn", "97800"), ("r7", "isbn", "97801"), ("r8", "isbn", "97802"))
    assert emitted(rules(body)(one)) == [("r7", "key", "97800-X-3"), ("r7", "key", "97801-X-3"), ("r8", "key", "97802-X-X")]
    two = one.unionByName(props(spark, ("r7", "volume", "part 12 of 20")))
    assert emitted(rules(body)(two)) == [("r7", "key", "97800-12-3"), ("r7", "key", "97801-12-3"), ("r8", "key", "97802-X-X")]


def test_leader_and_identifier(spark):
    leader = rules('<data source="leader" name="level"><substring start="10" end="11"/><lookup><entry name="m" value="part"/></lookup></data><data source="leader" name="type"><constant value="bib"/></data>')
    assert emitted(leader(props(spark, ("1", "leader", "0123456789m12345")))) == [("1", "level", "part"), ("1", "type", "bib")]
    number = rules('<combine name="number" value="${n}"><data source="016  .a" name="n"><regexp match="^\\[lib\\]\\s*(.*)$" format="${1}"/></data></combine>')
    assert emitted(number(props(spark, ("1", 0, "016  ", "a", "[lib] 4711"), ("1", 1, "016  ", "a", "[other] 9")))) == [("1", "number", "4711")]


def test_entities(spark):
    missing = rules('<choose name="rel" flushWith="creator"><data source="creator.rel"/><data source="creator.name"><constant value="missing"/></data></choose>')
    rows = props(spark, ("1", 0, "creator", "name", "A"), ("1", 1, "creator", "name", "B"), ("1", 1, "creator", "rel", "aut"))
    assert emitted(missing(rows)) == [("1", "rel", "aut"), ("1", "rel", "missing")]
    names = rules('<combine name="name" value="${a}${b}" flushWith="record"><data source="n.a" name="a"/><concat name="b" delimiter=", " prefix=" &lt;" postfix="&gt;"><data source="n.g|n.f"/></concat></combine>')
    assert emitted(names(props(spark, ("1", 0, "n", "a", "x"), ("1", 0, "n", "g", "g"), ("1", 0, "n", "f", "f"), ("2", 0, "n", "a", "y")))) == [("1", "name", "x <g, f>"), ("2", "name", "y")]


def test_codes_at_all_levels_and_their_pairs(spark):
    codes = spark.createDataFrame([("1", "ddc", "10"), ("1", "ddc", "12"), ("1", "rvk", "AA2")], "id string, kind string, value string")
    parts = {k: codes.where(F.col("kind") == k).select("id", F.lit(0).alias("pos"), F.explode(fn.prefixes(F.col("value"))).alias("value")) for k in ("ddc", "rvk")}
    once = {k: collectors.unique(p) for k, p in parts.items()}
    assert sorted(r.value for r in once["ddc"].collect()) == ["1", "10", "12"]
    assert collectors.tuples(once, "-").count() == 9


def test_bundles_and_moves(spark):
    keys = spark.createDataFrame([("DNB-1", "b"), ("DNB-1", "a"), ("HEB-2", "a"), ("HEB-3", "b"), ("BVB-4", "z"), (None, "z"), ("X-9", None)], "id string, key string")
    got = {r.bundle_id: (r.contains, r.eq) for r in matching.match(keys, "t").collect()}
    assert got == {"t$a": (["DNB-1", "HEB-2"], ["t$b"]), "t$b": (["HEB-3"], []), "t$z": (["BVB-4"], [])}
    members = matching.memberships(keys, "t")
    assert sorted((r.id1, r.id2) for r in matching.match_list(members).collect()) == [("DNB-1", "HEB-2"), ("HEB-2", "DNB-1")]
    assert {(r.i, r.j): r.overlap for r in matching.match_overlap(members).collect()} == {("DNB", "DNB"): 0, ("DNB", "HEB"): 1, ("HEB", "DNB"): 1, ("HEB", "HEB"): 0, ("BVB", "BVB"): 0}
    moved = matching.redirects(matching.bundle_edges(matching.match(keys, "t")))
    assert [(r.node, r.redirect) for r in moved.collect()] == [("t$b", "t$a")]
    assert sorted((r.bundle_id, r.id) for r in matching.move_members(members, moved).collect()) == [("t$a", "DNB-1"), ("t$a", "HEB-2"), ("t$a", "HEB-3"), ("t$z", "BVB-4")]
    assert sorted((r.id, r.rep) for r in matching.dedupe(keys).collect()) == [("BVB-4", "BVB-4"), ("DNB-1", "DNB-1"), ("HEB-2", "DNB-1"), ("HEB-3", "DNB-1")]


def test_components_against_brute_force(spark):
    r = random.Random(11)
    edges = [(f"n{r.randrange(120):03d}", f"n{r.randrange(120):03d}") for _ in range(90)] + [(f"p{k:03d}", f"p{k + 1:03d}") for k in range(150)] + [(None, "x")]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        if a:
            p, q = root(a), root(b)
            up[max(p, q)] = min(p, q)
    got = {x.node: x.component for x in components.connected_components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert got == {n: root(n) for a, b in edges if a for n in (a, b)}


def test_rekeying_and_conflicts(spark):
    moved = enrich.apply_redirects(props(spark, ("1", "{to:2}colour", "green"), ("1", "colour", "red")))
    assert emitted(moved) == [("1", "colour", "red"), ("2", "colour", "green")]
    both = enrich.rekey(props(spark, ("1", "key", "a"), ("1", "key", "b"), ("1", "p", "x"), ("2", "p", "y")), "key").where("name = 'p'")
    assert emitted(both) == [("a", "p", "x"), ("b", "p", "x")]
    keys = spark.createDataFrame([("1", "k"), ("2", "k")], "id string, key string")
    found = enrich.conflicts(props(spark, ("1", "p", "b"), ("2", "p", "c"), ("1", "q", "s"), ("2", "q", "s")), keys).collect()
    assert [(r.key, r.name, r["values"]) for r in found] == [("k", "p", ["b", "c"])]


def test_encoded_records(spark):
    rows = props(spark, ("a", "x", "1"), ("a", 3, "g", "y", "2"), ("a", 3, "g", "z", "3-<>"), ("a", 5, "g", "y", "4"), ("b", "x", ""))
    back = model.decode_records(model.encode_records(rows)).collect()
    assert sorted((r.id, r.ent or "", r.ent_no or 0, r.name, r.value) for r in back) == [("a", "", 0, "x", "1"), ("a", "g", 1, "y", "2"), ("a", "g", 1, "z", "3-<>"), ("a", "g", 2, "y", "4"), ("b", "", 0, "x", "")]


def test_library_formats(spark):
    pica = spark.createDataFrame([("001A \x1f0x\x1e003@ \x1f0123\x1e021A \x1faTitle\x1fbRest\x1e",)], "value string")
    assert emitted(library.ingest(pica, "pica", prefix="P-")) == [("P-123", "0", "123"), ("P-123", "0", "x"), ("P-123", "a", "Title"), ("P-123", "b", "Rest")]
    fields = [("001", "77\x1e"), ("245", "10\x1faTitel ü\x1fcX\x1e")]
    directory, data = "", b""
    for tag, f in fields:
        directory += f"{tag}{len(f.encode()):04d}{len(data):05d}"
        data += f.encode()
    base = 24 + len(directory) + 1
    raw = f"{base + len(data) + 1:05d}nam a22{base:05d} a 4500" + directory + "\x1e" + data.decode() + "\x1d"
    marc = library.decode_marc21(spark.createDataFrame([(raw,), ("broken",)], "value string")).collect()
    assert ("77", "24510", "a", "Titel ü") in {(r.id, r.ent, r.name, r.value) for r in marc} and any(r.name == "error" for r in marc)
    mab = spark.createDataFrame([("x" * 24 + "001 9\x1e331 Title\x1e\x1d",)], "value string")
    assert {("9", "331", "Title"), ("9", "001", "9")} <= {(r.id, r.name, r.value) for r in library.decode_mab2(mab).collect()}


def test_wiki_pages(spark, tmp_path):
    (tmp_path / "w.xml").write_text("<mediawiki><page><title>T</title><id>5</id><revision><text>see [[A|b]] [[Category:C]]</text></revision></page></mediawiki>")
    got = lines.wiki_props(lines.wiki_pages(spark, str(tmp_path / "w.xml")))
    assert emitted(got) == [("5", "category", "C"), ("5", "link", "A"), ("5", "title", "T")]
    assert [len(r.x) for r in spark.sql("select '{{t}} <ref>a</ref> http://x.y/z <!-- c --> [[de:U]]' as v").select(F.explode(F.array(*[fn.wiki_patterns(F.col("v"), k) for k in ("template", "reference", "url", "comment", "language_link")])).alias("x")).collect()] == [1, 1, 1, 1, 1]


def test_sinks(spark, tmp_path):
    counts = spark.createDataFrame([("1", "all", 3), ("1", "a", 2), ("2", "a", 1)], "target string, type string, n long")
    sinks.write_beacon(counts, str(tmp_path / "beacon"))
    files = sorted((tmp_path / "beacon" / "type=a").glob("part-*"))
    assert "".join(f.read_text() for f in files).splitlines() == ["#FORMAT: PND-BEACON", "#VERSION: 0.1", "#TARGET: {ID}", "1|2", "2|1"]
    index = text.inverted_index(spark.createDataFrame([(1, "b a b"), (2, "a")], "id long, t string"), "id", {"t": "words"})
    sinks.write_index(index, str(tmp_path / "index"))
    assert sorted((r.field, r.term, r.id) for r in spark.read.parquet(str(tmp_path / "index")).collect()) == [("t", "a", 1), ("t", "a", 2), ("t", "b", 1)]
    sinks.write_report(counts, str(tmp_path / "report"))
    assert spark.read.csv(str(tmp_path / "report"), header=True).count() == 3
    rows = props(spark, ("a", "x", "1"), ("a", "", "2"))
    assert [r.line for r in sinks.grouped_lines(rows).collect()] == ["a\t\tx=1\t2"]
    sinks.write_lines(sinks.grouped_lines(rows, names=False), str(tmp_path / "lines"))
    assert [r.value for r in spark.read.text(str(tmp_path / "lines")).collect()] == ["a\t\t1\t2"]
    assert tables.upsert(spark, rows, rows).count() == 2


def test_scalars(spark):
    df = spark.createDataFrame([("0-306-40615-2",), ("978-0-306-40615-7",), ("0-306-40615-3",), ("x",), (None,), ("080442957X",)], "v string")
    assert [r.i for r in df.select(fn.isbn13(F.col("v")).alias("i")).collect()] == ["9780306406157", "9780306406157", None, None, None, "9780804429573"]
    assert text.german_stem("häuser") == "haus" and text.german_stem("laufen") == "lauf"
    assert spark.range(1).select(fn.set_replace(F.lit("aäb"), {"ä": "e", "b": ""}).alias("x")).first().x == "ae"


def test_streaming(spark, tmp_path):
    from propweave import streaming
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1\tx=1\ty=2\n2\tx=3\n")
    out = str(tmp_path / "out")
    q = streaming.apply(streaming.read_lines(spark, str(tmp_path / "in")), lines.parse_props, streaming.parquet_sink(out), str(tmp_path / "cp"))
    q.awaitTermination(60)
    streaming.parquet_sink(out)(lines.parse_props(spark.read.text(str(tmp_path / "in"))), 0)  # the first batch once more
    assert emitted(spark.read.parquet(out)) == [("1", "x", "1"), ("1", "y", "2"), ("2", "x", "3")]


def test_stems_are_counted(spark):
    """Counts of stems, as stemming each occurrence gives them."""
    rows = ["Die Häuser und das Haus, 3 Häusern 12 a@b.de", "laufen lief läuft Häuser häuser", None, ""]
    want = {}
    for t in rows:
        for w in re.findall(r"[^\W_]+", re.sub(r"\S+@\S+", " ", (t or "").lower())):
            if len(w) >= 3 and not w.isdigit() and w not in text.GERMAN_STOP_WORDS:
                want[text.german_stem(w)] = want.get(text.german_stem(w), 0) + 1
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    assert {r.token: r.n for r in text.count_tokens(df, tokenizer="german").collect()} == want and want["haus"] == 5


def test_running_counts_on_a_stream(spark, tmp_path):
    from propweave import streaming
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\ny\nx\n")
    counts = streaming.running_counts(streaming.read_lines(spark, str(tmp_path / "in")), "value")
    q = counts.writeStream.outputMode("complete").format("memory").queryName("running").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r.value: r.n for r in spark.table("running").collect()} == {"x": 2, "y": 1}


def test_programs_name_what_they_do_not_know(spark):
    for body in ('<uper/>', '<data source="a"><uper/></data>', '<combine name="x" value=""><daat source="a"/></combine>', '<call-macro name="none"/>', '<data source="a"><lookup in="none"/></data>', '<data source="a" name="$[x]"/>'):
        with pytest.raises(ValueError):
            rules(body)
    with pytest.raises(ValueError):
        rules('<data source="@a" name="@b"/><data source="@b" name="@a"/>')(props(spark, ("1", "a", "x")))
    with pytest.raises(ValueError):
        parse('<m><rules/><maps><filemap name="m" files="x"/></maps></m>')


def test_combine_with_reset_against_an_interpreter(spark):
    r = random.Random(5)
    rows, want = [], []
    for i in range(40):
        now, pos = {}, 0
        for _ in range(r.randrange(12)):
            c = r.choice("ab")
            rows.append((f"r{i}", pos, c, f"{c}{pos}"))
            now[c] = f"{c}{pos}"
            if len(now) == 2:
                want.append((f"r{i}", pos, now["a"] + "+" + now["b"]))
                now = {}
            pos += 1
    df = spark.createDataFrame(rows, "id string, pos int, child string, value string")
    got = collectors.combine_reset({c: df.where(F.col("child") == c).select("id", "pos", "value") for c in "ab"}, "${a}+${b}")
    assert sorted((x.id, x.pos, x.value) for x in got.collect()) == sorted(want)


def test_groups_macros_counts_and_group(spark):
    rows = props(spark, ("1", 4, "person", "name", "Ada"), ("1", 4, "person", "role", "aut"), ("1", 7, "person", "name", "Bo"), ("1", "x", "p"), ("1", "x", "q"))
    made = rules('<entity name="who" flushWith="person"><data source="person.name" name="n"/><choose><data source="person.role" name="r"/><data source="person.rank" name="k"/></choose></entity>')(rows)
    assert sorted((r.ent, r.ent_no, r.name, r.value) for r in made.collect()) == [("who", 4, "n", "Ada"), ("who", 4, "r", "aut"), ("who", 7, "n", "Bo")]
    assert emitted(rules('<data source="person" name="start"><constant value="here"/></data><data source="_else"/>')(rows)) == [("1", "person.name", "Ada"), ("1", "person.name", "Bo"), ("1", "person.role", "aut"), ("1", "start", "here"), ("1", "start", "here"), ("1", "x", "p"), ("1", "x", "q")]
    assert emitted(rules('<group name="g"><data source="x"/><data source="person.role"/></group>')(rows)) == [("1", "g", "aut"), ("1", "g", "p"), ("1", "g", "q")]
    assert emitted(rules('<data source="x" name="k"><count/></data>')(rows)) == [("1", "k", "1"), ("1", "k", "2")]
    assert emitted(rules('<data source="x" name=""><occurrence only="2"/></data>')(rows)) == [("1", "", "q")]


def test_registered_steps_and_formats(spark):
    if "shout" not in program.STEPS:
        program.register_step("shout", lambda a, _: lambda v: F.concat(F.upper(v), F.lit(a.get("mark", "!"))))
        library.register_format("pairs", lambda df, line: lines.parse_props(df, line))
    assert emitted(rules('<data source="x" name="y"><shout mark="?"/></data>')(props(spark, ("1", "x", "a")))) == [("1", "y", "A?")]
    assert emitted(library.ingest(spark.createDataFrame([("7\tx=1",)], "value string"), "pairs", prefix="Q")) == [("Q7", "x", "1")]
    for taken in (lambda: program.register_step("trim", None), lambda: library.register_format("pica", None)):
        with pytest.raises(ValueError):
            taken()


def test_feedback_that_does_not_end(spark):
    endless = rules('<data source="@a|a" name="@a"><constant value="z"/></data><data source="@a" name="b"/>')
    with pytest.raises(Exception, match="doesn't end"):
        endless(props(spark, ("1", "a", "xyz"))).collect()


def test_marc_xml_and_lookups(spark, tmp_path):
    xml = '<collection xmlns="http://www.loc.gov/MARC21/slim"><record><leader>00000nam</leader><controlfield tag="001">5</controlfield><datafield tag="245" ind1="1" ind2="0"><subfield code="a">Title</subfield><subfield code="c">X</subfield></datafield></record></collection>'
    (tmp_path / "m.xml").write_text(xml)
    got = library.marc_xml(spark, str(tmp_path / "m.xml"))
    assert sorted((r.id, r.ent or "", r.name, r.value) for r in got.collect()) == [("5", "", "001", "5"), ("5", "", "leader", "00000nam"), ("5", "24510", "a", "Title"), ("5", "24510", "c", "X")]
    table = spark.createDataFrame([("a", "1"), ("a", "2"), (None, "3")], "key string, value string")
    rows = props(spark, ("1", "p", "a"), ("1", "p", "b"))
    assert emitted(enrich.lookup_join(rows, table)) == [("1", "p", "1")] and emitted(enrich.lookup_join(rows, table, "-")) == [("1", "p", "-"), ("1", "p", "1")]
    (tmp_path / "map.txt").write_text("k\tv\n" * 2)
    assert program.read_map(spark, str(tmp_path / "map.txt")) == {"k": "v"}


def test_errors_of_ingest_are_kept_and_counted(spark):
    lines_ = spark.createDataFrame([("broken",), ("",), (None,)], "value string")
    for kind in ("pica", "marc21", "mab2"):
        props_, seen = library.counted(library.ingest(lines_, kind, lambda p: p, "X-"), f"of-{kind}")
        got = [(r.id, r.name) for r in props_.collect() if r.name == "error"]
        assert got == [("error:" + hashlib.sha1(b"broken").hexdigest(), "error")] and seen.get["errors"] == 1, kind


def test_tables_of_cut_go_when_nothing_reads_them(spark):
    path = lambda df: df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    kept = lineage.cut(spark.range(3).selectExpr("id"), "kept")
    derived = lineage.cut(spark.range(4).selectExpr("id"), "derived").where("id > 0")
    gone = path(lineage.cut(spark.range(5).selectExpr("id"), "gone"))
    for _ in range(20):
        gc.collect()
        lineage.sweep(spark)
        if not os.path.exists(gone):
            break
        time.sleep(0.2)
    assert not os.path.exists(gone) and kept.count() == 3 and derived.count() == 3


def test_entry_module():
    import __spark_entry__ as entry
    from propweave import catalogue
    assert set(catalogue.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
