"""Schemas of the log, the page message and the JSON objects embedded in listing pages.

The JSON schemas and field names are fixed values: they have to equal what the
pages carry, so they are spelled out in the order of the page objects.
"""

# The three kinds of listing; each has its own log topic, bronze and silver table.
TARGETS = ("forsale", "sold", "canonical")

LOG_RECORD = (
    "key binary, value binary, topic string, partition int, offset long, "
    "timestamp timestamp, timestampType int"
)

BRONZE = (
    "key string, value string, topic string, partition int, offset long, "
    "timestamp timestamp, timestampType int, ingestion_date date"
)

PAGE_MESSAGE = "url string, source string, timestamp double"

PENDING = "url string"

VISITED = "target string, id string"

OFFSETS = "target string, topic string, partition int, next_offset long"

LOCATIONS = (
    "struct<country: string, county: string, municipality: string, postal_city: string, "
    "street: string, city: string, district: string>"
)

FORSALE_PROPS = f"""
    id int,
    broker_firm string,
    broker_agency_id int,
    location string,
    locations {LOCATIONS},
    new_production boolean,
    offers_selling_price boolean,
    status string,
    housing_form string,
    tenure string,
    street_address string,
    rooms double,
    living_area double,
    supplemental_area double,
    land_area double,
    driftkostnad int,
    price long,
    has_price_change boolean,
    upcoming_open_houses boolean,
    bidding boolean,
    has_floorplan boolean,
    publication_date string,
    construction_year string,
    callout string,
    amenities array<string>,
    water_distance long
"""

CANONICAL_PROPS = f"""
    id int,
    broker_firm string,
    broker_agency_id int,
    location string,
    locations {LOCATIONS},
    offers_selling_price boolean,
    status string,
    housing_form string,
    street_address string,
    borattavgift int,
    upcoming_open_houses boolean,
    long_description boolean,
    has_floorplan boolean,
    amenities array<string>
"""

SOLD_PROPS = f"""
    id long,
    broker_agency string,
    broker_agency_id int,
    location string,
    locations {LOCATIONS},
    street_address string,
    price long,
    selling_price long,
    rooms string,
    living_area string,
    sold_at_date string
"""

# Of the home's own object a sold page needs only the id.
SOLD_HOME = "id int"
