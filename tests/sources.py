"""Small sources, each row there for one special case."""

LABELS = (
    "/* I94CIT */\n"
    "   582 =  'MEXICO Air Sea'\n"
    ";\n"
    "/* I94PORT - valid codes */\n"
    "   'POO'\t=\t'PORTLAND, OR          '\n"
    "   'POM'\t=\t'PORTLAND, ME          '\n"
    "   'NYC'\t=\t'NEW YORK, NY          '\n"
    "   'WAS'\t=\t'WASHINGTON DC         '\n"
    "   'XXX'\t=\t'NOT REPORTED/UNKNOWN  '\n"
    ";\n"
    "/* I94MODE */\n"
    "   1 = 'Air'\n"
    ";\n"
)

DEMOGRAPHICS = """City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-Born;Average Household Size;State Code;Race;Count
Portland;Oregon;36.7;313516;318671;632187;29940;86041;2.43;OR;White;528140
Portland;Oregon;36.7;313516;318671;632187;29940;86041;2.43;OR;Asian;58000
Portland;Oregon;36.7;313516;318671;632187;29940;86041;2.43;OR;Asian;57000
Portland;Maine;38.0;32000;34875;66875;;9000;2.1;ME;White;56000
New York;New York;36.0;4081698;4468707;8550405;156961;3212500;2.68;NY;Hispanic or Latino;2485125
New York;New York;36.0;4081698;4468707;8550405;156961;3212500;2.68;NY;Black or African-American;2192248
Washington;District of Columbia;33.8;319705;352523;672228;25963;95117;2.24;DC;White;285402
"""

AIRPORTS = """ident,type,name,iso_country,iso_region
00A,heliport,Total Rf,US,US-PA
00A,heliport,Total Rf,US,US-PA
00B,small_airport,Two,US,US-U-A
00C,closed,Three,US,US
00D,small_airport,Four,CA,
00A,heliport,Renamed,US,US-PA
"""

ARRIVALS = """cicid,i94yr,i94mon,i94port,arrdate
6.0,2016.0,4.0,NYC,20573.0
6.0,2016.0,4.0,NYC,20573.0
7.0,2016.0,4.0,POO,20545.0
8.0,2016.0,4.0,ZZZ,20573.0
9.0,2016.0,4.0,POM,
10.0,2016.0,4.0,,20573.0
11.0,2015.0,12.0,XXX,20453.0
"""

TEMPERATURES = """dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude
1989-02-07,1.0,0.1,Portland,United States,45.81N,123.46W
1989-02-08,2.0,0.1,Portland,United States,45.81N,123.46W
1989-02-09,3.0,0.1,New York,United States,40.99N,74.56W
2013-09-01,15.5,0.2,Portland,United States,45.81N,123.46W
2013-09-01,15.5,0.2,Portland,United States,45.81N,123.46W
2013-09-01,15.5,0.3,Portland,United States,45.81N,123.46W
2013-09-01,,,New York,United States,40.99N,74.56W
2013-09-01,9.9,0.3,Washington,United Kingdom,55.45N,1.2W
2013-10-05,5.5,0.3,New York,United States,40.99N,74.56W
,7.5,0.3,New York,United States,40.99N,74.56W
"""


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, newline="")
    return str(path)
