"""Columns of the sources and of the tables built from them."""

from __future__ import annotations

# Types of source columns that are not text, applied by name; undeclared columns stay as they are.
DEMOGRAPHICS_TYPES = {
    "Median Age": "double",
    "Male Population": "int",
    "Female Population": "int",
    "Total Population": "int",
    "Number of Veterans": "int",
    "Foreign-Born": "int",
    "Average Household Size": "double",
    "Count": "int",
}
TEMPERATURE_TYPES = {"dt": "date", "AverageTemperature": "double"}

# The grouping columns of the demographics source.
DEMOGRAPHICS_KEYS = [
    "City",
    "State",
    "Median Age",
    "Male Population",
    "Female Population",
    "Total Population",
    "Number of Veterans",
    "Foreign-Born",
    "Average Household Size",
    "State Code",
]

# The race names of the demographics source and the columns they become.
RACES = {
    "American Indian and Alaska Native": "ai_an",
    "Asian": "Asian",
    "Black or African-American": "black_aa",
    "Hispanic or Latino": "h_l",
    "White": "White",
}

# The demographics columns that become table columns, and their names there.
DEMOGRAPHICS_NAMES = {
    "Median Age": "median_age",
    "Male Population": "male_pop",
    "Female Population": "female_pop",
    "Total Population": "total_pop",
    "Number of Veterans": "veterans_num",
    "Foreign-Born": "Foreign-Born",
    "Average Household Size": "avg_household",
    "State Code": "state_code",
    **RACES,
}

# The output tables, column -> type, in stored order (partition column last).
PORTS = {"port_id": "string", "city_state": "string", "city": "string", "state": "string"}
AIRPORTS = {"ident": "string", "type": "string", "iso_region": "string", "state": "string"}
DEMOGRAPHICS = {
    "port_id": "string",
    "city_lower": "string",
    "median_age": "double",
    "male_pop": "int",
    "female_pop": "int",
    "total_pop": "int",
    "veterans_num": "int",
    "Foreign-Born": "int",
    "avg_household": "double",
    "state_code": "string",
    "ai_an": "int",
    "Asian": "int",
    "black_aa": "int",
    "h_l": "int",
    "White": "int",
}
ARRIVALS = {
    "cicid": "string",
    "arrival_date": "date",
    "i94port": "string",
    "port_city": "string",
    "port_state": "string",
    "month": "int",
    "year": "int",
}
TEMPERATURES = {"AverageTemperature": "double", "city_lower": "string", "port_id": "string", "dt": "date"}

# Names of the built tables.
TABLES = {"airport": AIRPORTS, "city_demo": DEMOGRAPHICS, "imm": ARRIVALS, "land_temp": TEMPERATURES}


def ddl(columns: dict[str, str]) -> str:
    """Schema text of a table, as Spark's readers take it."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
