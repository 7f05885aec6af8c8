import duckdb
from llm.cases import ODD_ROWS, rows

from trendlake.llm import oracles
from trendlake.llm.license_scans import TEMPLATES, Scanner, bigrams, dice, normalised, scan

MIT = next(t for n, t in TEMPLATES if n == "MIT" and len(t) > 100)


def test_planted_licences(spark):
    words = MIT.split()
    given = {
        1: "Some prose here.\nreleased under the MIT license\nMore prose follows.",
        2: "Prose first.\n\n" + "\n".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12)) + "\n\nprose last",
        3: " ".join(w for i, w in enumerate(words) if i % 30),
        4: "Licensed under CC BY-NC 4.0.\nAll rights reserved.",
        5: "licensed to drive under the bridge",
        6: "this work is licensed under the gnu general public license, version 3!",
        7: "MIT",
        8: "prose " * 50_000 + "\nAll Rights Reserved\n" + "prose " * 50_000,
    }
    got = {r.doc_id: r for r in scan(spark.createDataFrame(list(given.items()), "doc_id bigint, text string")).collect()}
    assert {i: r.license for i, r in got.items()} == {1: "MIT", 2: "MIT", 3: "MIT", 4: "All-Rights-Reserved", 5: None, 6: "GPL-3.0", 7: None, 8: "All-Rights-Reserved"}
    assert got[4].licenses == ["All-Rights-Reserved", "CC-BY-NC-4.0"] and got[4].n_matches == 3  # both lines, and the two as a paragraph
    assert got[1].license_score == 1.0 and 0.8 <= got[3].license_score < 1


def test_pruning_by_size_loses_nothing():
    scanner = Scanner.of(least=0.5)
    words = normalised(MIT.encode())
    for size in range(0, len(words), 7):
        grams = bigrams(words[:size])
        plain = max((dice(grams, b) for _, b in scanner.templates), default=0)
        found = scanner.match(grams)
        assert (found[0] if found else 0) == (plain if plain >= 0.5 else 0)


def test_as_in_sql(spark, odd, tmp_path):
    text = "\n \nAll rights reserved.\n\t\nx y\nReleased under the MIT License\n\n\n" + MIT + "\r\n\r\nLicensed under CC BY 4.0"
    df = odd.unionByName(spark.createDataFrame([(90, text, "en", "a"), (91, text[4:], "en", "a")], odd.schema))
    df.coalesce(1).write.parquet(str(tmp_path / "d"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = db.sql(oracles.licenses_sql(TEMPLATES, 0.8)).fetchall()
    got = scan(df).selectExpr("doc_id", "license", "license_score", "n_matches", "array_join(licenses, ',') AS licenses")
    assert rows(got) == sorted(map(tuple, want), key=repr)
    assert any(r[3] > 3 for r in want)


def test_odd_rows(odd, empty, clashing):
    got = scan(clashing(odd, "license", "N_matches", "_m"))
    assert rows(got, "doc_id", "license", "n_matches") == sorted(((i, None, 0) for i, *_ in ODD_ROWS), key=repr)
    assert scan(empty).collect() == []


def found_in(text):
    return sorted(Scanner.of().scan(text.encode()), key=lambda m: (-m[0], m[1]))


def paragraphs_of(text, *starts):
    for start in starts:
        text = text.replace(start, "\n\n" + start)
    return text


def test_texts_of_several_paragraphs_and_notices_inside_lines(spark):
    prose = "".join(f"word{i} said that it is{i} so.{chr(10) * (i % 9 // 7)} " for i in range(400))
    mit = paragraphs_of(MIT, "The above copyright", "THE SOFTWARE IS")
    apache = next(t for n, t in TEMPLATES if n == "Apache-2.0" and len(t) > 100)
    apache = paragraphs_of(apache, "You may obtain", "Unless required")
    given = {
        1: f"{prose}\n\n{mit}\n\n{prose}",
        2: f"{prose}\n\n# {apache}\n\n{prose}".replace("License", "Licence", 1),
        3: f"{prose} This is released under the MIT License, {prose} (c) Me. All rights reserved. {prose}",
        4: f"{prose}\nthis work is licensed under the GNU\nGeneral Public License, version\n3. {prose}",
        5: f"Copyright (c) Me. All rights reserved, but: {MIT}",
        6: f"{prose} released after the MIT licence, all are reserved {prose}",
        7: f"{mit} {mit}",
    }
    got = {r.doc_id: r for r in scan(spark.createDataFrame(list(given.items()), "doc_id bigint, text string")).collect()}
    assert {i: (r.licenses, r.n_matches) for i, r in got.items()} == {
        1: (["MIT"], 1),
        2: (["Apache-2.0"], 1),
        3: (["All-Rights-Reserved", "MIT"], 2),
        4: (["GPL-3.0"], 1),
        5: (["All-Rights-Reserved", "MIT"], 2),  # the line as a unit, and the words before the licence
        6: ([], 0),
        7: (["MIT"], 2),  # the whole text and its middle paragraph, which the runs meet
    }
    assert [got[i].license_score for i in (1, 3, 4)] == [1.0, 1.0, 1.0] and 0.8 <= got[2].license_score <= 1


def test_best_run_from_each_start_as_by_trying_all(spark):
    random = __import__("random").Random(5)
    for least in (0.5, 0.8, 1.0):
        scanner = Scanner.of(least=least)
        for k, (_, grams) in enumerate(scanner.templates):
            base = normalised(TEMPLATES[k][1].encode())
            if len(base) > 20:
                base = base[: 2 + len(base) // 8]
                scanner = Scanner.of([*TEMPLATES[:k], (TEMPLATES[k][0], b" ".join(base).decode()), *TEMPLATES[k + 1 :]], least)
                grams = scanner.templates[k][1]
            words = [w for w in (base + [b"x", b"the"]) * 3 if random.random() > 0.1]
            pairs = list(zip(words, words[1:]))
            want = []
            for start, pair in enumerate(pairs):
                spans = range(start + 1, min(len(pairs), start + scanner.longest[k]) + 1) if pair in grams else ()
                best = max(((dice(frozenset(pairs[start:end]), grams), -end) for end in spans), default=(0, 0))
                if best[0] >= least:
                    want.append((best[0], start, 1 - best[1]))
            assert list(scanner.runs(pairs, k)) == want


def test_many_notices_in_one_line_stay_quick():
    assert found_in("x All rights reserved " * 30_000) == [(1.0, "All-Rights-Reserved")] * 30_000
    assert len(found_in(" ".join(f"{MIT} {i} {i}" for i in range(60)))) == 60


def test_usual_notices_are_found_under_their_own_licence():
    for name, text in TEMPLATES:
        assert found_in(f"Some words.\n{text}\nMore of them.")[0] == (1.0, name)
        inside = found_in(f"It says here: {text} And so on, with more words than before it, so that no short line is one.")
        assert {n for _, n in inside} == {name} and inside[0][0] == 1.0 or len(text) > 150
    asked = {
        "Licensed under the BSD 3-Clause License.": "BSD-3-Clause",
        "Licensed under the MIT License.": "MIT",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
        "Released under the BSD 2-Clause License": "BSD-2-Clause",
        "// SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1",
        "# SPDX-License-Identifier: GPL-3.0-only": "GPL-3.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
        "// SPDX-License-Identifier: Other-9": None,
        "// SPDX-License-Identifier: GPL-9.0": None,
        "Licensed under the Apache License, Version 1.1.": "Apache-1.1",
        "It is licensed under the Mozilla Public License 1.1 as a whole, and so on and so on.": "MPL-1.1",
    }
    assert {text: (found_in(text) or [(0, None)])[0][1] for text in asked} == asked


def test_versions_and_wordings_are_told_apart():
    wanted = {
        "Licensed under the Apache License 2.0": "Apache-2.0",
        "Licensed under CC BY 3.0.": "CC-BY-3.0",
        "Licensed under CC BY-SA 3.0.": "CC-BY-SA-3.0",
        "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
        "Licensed under CC BY-NC-ND 2.5": "CC-BY-NC-ND-2.5",
        "licensed under CC BY-SA": "CC-BY-SA",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.": "CC-BY-SA-3.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    for text, name in wanted.items():
        for shown in (text, f"Prose before. {text} And some prose after that", f"x\n{text}\ny"):
            assert found_in(shown)[0][1] == name, shown
