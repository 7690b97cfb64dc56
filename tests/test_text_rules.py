"""Keyword and HTML rules on hand-made inputs (branches the driver data never reaches)."""

from pyspark.sql import functions as F

from surgecast.functions import text as tx
from surgecast.sources import decode


# Name, keywords, cleaned keywords, written out by hand from the rule's description.
EXPECTED = [
    ("New York Rangers at Ohio State Buckeyes",
     [" Buckeyes", " Rangers", "New York Rangers", "Ohio State Buckeyes", "York Rangers"],
     [" Buckeyes", " Rangers", "New York Rangers", "Ohio State Buckeyes", "York Rangers"]),
    ("Kansas City Chiefs at Los Angeles Lakers",
     [" Chiefs", " Lakers", "Angeles Lakers", "Kansas City Chiefs", "Los Angeles Lakers"],
     [" Chiefs", " Lakers", "Angeles Lakers", "Kansas City Chiefs", "Los Angeles Lakers"]),
    ("Notre Dame Fighting Irish at South Florida Bulls",
     [" Bulls", " Fighting Irish", "Dame Fighting Irish", "Florida Bulls", "Notre Dame Fighting Irish", "South Florida Bulls"],
     [" Bulls", " Fighting Irish", "Dame Fighting Irish", "Florida Bulls", "Notre Dame Fighting Irish", "South Florida Bulls"]),
    ("Boston at Denver", ["", "Boston", "Denver"], ["Boston", "Denver"]),
    ("St. Louis Blues at Someone Else's Team!",
     ["Else's Team!", "Louis Blues", "Someone Else's Team!", "St. Louis Blues"],
     ["Louis Blues", "Someone s Team", "St. Louis Blues", "s Team"]),
    ("Oklahoma State at Iowa State", ["", "Iowa State", "Oklahoma State"], ["Iowa State", "Oklahoma State"]),
]


def test_team_keywords(spark):
    df = spark.createDataFrame([(n,) for n, _, _ in EXPECTED], "name string")
    kw = tx.team_keywords("name")
    got = {r.name: (r.k, r.c) for r in df.select("name", kw.alias("k"), tx.clean_keywords(kw).alias("c")).collect()}
    assert got == {n: (k, c) for n, k, c in EXPECTED}


def test_html_table_cells_are_stripped(spark):
    html = ("<table class='x'><tr><th>Rk</th><th> Team </th><th>Pts</th></tr>"
            "<tr><td>0</td><td>sub header</td></tr>"
            "<tr><td> 1 </td><td><a href='/t'>North  Dakota</a></td><td>9</td></tr>"
            "<tr>\n<td>2</td>\n<td><b>Boston</b> College</td></tr></table>")
    bad = "<table><tr><th>Team</th><th>Rk</th></tr><tr><td>x</td><td>y</td></tr><tr><td>1</td><td>z</td></tr></table>"
    pages = spark.createDataFrame([(1, html), (2, bad)], "page_id long, html string")
    got = sorted((r.page_id, r.team_name, r.league_rank, r.year) for r in decode.ranking_table(pages, 2023).collect())
    assert got == [(1, "Boston College", 2, 2023), (1, "North  Dakota", 1, 2023)]
