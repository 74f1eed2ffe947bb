"""Lookup files in the formats they come in."""

from notemask import build_gazetteers, tag_notes
from notemask.sources import readers


def test_files_to_labels(spark, tmp_path):
    def put(name, text, encoding="utf-8"):
        path = tmp_path / name
        path.write_bytes(text.encode(encoding))
        return str(path)

    names = put("names.csv", "name,count\nSarah,1\nsarah,2\nO'Brien,3\n,4\n")
    states = put("states.txt", "NE\nnebraska\nNE\n")
    zips = put("zips.csv", "ZIP,other\n07052,1\n07052,2\n")
    cities = put("cities.csv", "a|b|c|d|e\nLincoln|NE|Nebraska|Lancaster|Linc\n88|NE|Nebraska|X|Y\nToronto|ON|Ontario|York|T\nNebraska|NE|Nebraska|X|Y\n")
    extra = put("extra.csv", "i,sc,sf,c,co,la,lo\n1,PR,Puerto Rico,Mayagüez,M,1,2\n2,AL,Alabama,Lincoln,T,3,4\n", "latin1")
    g = build_gazetteers(
        readers.read_names(spark, names),
        readers.read_states(spark, states),
        readers.read_zips(spark, zips),
        readers.read_cities(spark, cities),
        readers.read_extra_cities(spark, extra),
    )
    assert sorted(r["name"] for r in g.names.collect()) == ["O'Brien", "Sarah"]
    assert [r["zipcode"] for r in g.zips.collect()] == ["07052"]
    assert {r["state"] for r in g.states.collect()} >= {"NE", "Nebraska", "Puerto Rico", "Guam"}
    assert {r["city"]: [tuple(s) for s in r["states"]] for r in g.city_states.collect()} == {
        "Lincoln": [("Nebraska", "NE")],
        "Mayagüez": [("Puerto Rico", "PR")],
    }
    assert {r["county"] for r in g.county_states.collect()} == {"Lancaster"}

    notes = spark.createDataFrame([(1, "Sarah in Lincoln, NE")], "note_id long, body string")
    notes.write.parquet(str(tmp_path / "notes"))
    read = readers.read_notes(spark, str(tmp_path / "notes"), "note_id", "body")
    rows = tag_notes(read, g.lexicon(), "note_id", "body")
    readers.write_labels(rows, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == ["note_id", "body", "cleaned", "iob", "masked"]
    assert back.first()["masked"] == "PersonName in PAddress, PAddress"
    assert readers.sample_rows(back, 1).count() == 1


def test_bad_lines_are_kept_apart(spark, tmp_path):
    layout = readers.FORMATS["cities"]
    path = tmp_path / "cities.csv"
    path.write_text('a|b|c|d|e\nLincoln|NE|Nebraska|Lancaster|Linc\nshort|NE\n\n"Quo|ted"|NE|N|L|Q\nlong|NE|N|L|Q|more\n||||\n')
    rows, seen = readers.load_checked(spark, str(path), layout, str(tmp_path / "bad"))
    assert sorted(tuple(r) for r in rows.na.fill("").collect()) == [
        ("", "", "", "", ""), ("Lincoln", "NE", "Nebraska", "Lancaster", "Linc"), ("Quo|ted", "NE", "N", "L", "Q"),
    ]
    assert seen == {"lines": 5, "bad": 2}
    bad = spark.read.json(str(tmp_path / "bad")).collect()
    assert sorted(r[readers.BAD_LINE] for r in bad) == ["long|NE|N|L|Q|more", "short|NE"]
    assert all(r["file"].endswith("cities.csv") for r in bad)


def test_checked_files_of_other_layouts(spark, tmp_path):
    wide = readers.FileFormat(("name", "count"))
    (tmp_path / "names.csv").write_text("name,count\nSarah,1\nKlein\nO'Brien,2\n")
    lines = readers.read_checked(spark, str(tmp_path / "names.csv"), wide)
    assert sorted(r["name"] for r in readers.good_lines(lines).select("name", "count").collect()) == ["O'Brien", "Sarah"]
    (tmp_path / "extra.csv").write_bytes("h,h,h,h,h,h,h\n1,PR,Puerto Rico,Mayagüez,M,1,2\n".encode("latin1"))
    extra = readers.good_lines(readers.read_checked(spark, str(tmp_path / "extra.csv"), readers.FORMATS["extra_cities"]))
    assert extra.first()["City"] == "Mayagüez"
    (tmp_path / "none.txt").write_text("")
    rows, seen = readers.load_checked(spark, str(tmp_path / "none.txt"), readers.FORMATS["states"], str(tmp_path / "q"))
    assert rows.count() == 0 and seen == {"lines": 0, "bad": 0}
