"""Values that define the catalogue's published results."""

# Boundaries of the release-year ranges. Range i covers the years
# boundary[i] + 1 .. boundary[i + 1], both ends included.
YEAR_BOUNDARIES = (1899, 1950, 1980, 1990, 2000, 2010, 2012, 2014, 2016, 2018, 2020, 2023)

# Titles per page.
PAGE_SIZE = 120

# The object type that carries a season count.
SHOW = "SHOW"

# Services selected by default, as (code, clear name).
SELECTED_SERVICES = (
    ("amp", "Amazon Prime Video"),
    ("atp", "Apple TV Plus"),
    ("cru", "Crunchyroll"),
    ("dnp", "Disney Plus"),
    ("hbm", "HBO Max"),
    ("hlu", "Hulu"),
    ("nfx", "Netflix"),
    ("pmp", "Paramount Plus"),
    ("pct", "Peacock"),
    ("pcp", "Peacock Premium"),
    ("tbv", "Tubi TV"),
    ("yot", "YouTube"),
    ("yfr", "YouTube Free"),
    ("ytr", "YouTube Premium"),
)

# Flag picture of a country, filled with its alpha-3 code.
FLAG_PATTERN = "https://cdn.worlddata.info/pics/flags3d/%s.png"
