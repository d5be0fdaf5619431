"""A small brokerage to test with."""

import datetime as dt
from decimal import Decimal

from deedflow.sources.literals import literal_batch

# The ids, places, prices, dates and ratings below decide the results that
# the tests state.  Contacts, sizes, comments and the like decide nothing and are made
# by rule further down.

# company_ID, comp_name
COMPANIES = [
    (165, "Realty"),
    (995, "Consul Properties"),
    (631, "Best Homes Inc."),
    (652, "Dream Estates"),
    (323, "Elite Realtors"),
    (753, "Golden Properties"),
    (125, "Sunset Realty"),
    (787, "Silver Oak Estates"),
]

# owner_ID
OWNERS = [1254, 1561, 1356, 1478, 1524, 1682, 1097, 1832, 1291, 1109, 1114, 1293]

# property_ID, owner_ID, property_TYPE, prop_status, city, listing_price
PROPERTIES = [
    (2651, 1254, "House", "For Sale", "Hawaii", 500000),
    (2736, 1561, "Apartment", "For Sale", "California", 300000),
    (2095, 1356, "Condominium", "For Sale", "Florida", 400000),
    (2409, 1478, "House", "For Sale", "California", 600000),
    (2107, 1293, "Condominium", "Sold", "Chicago", 925000),
    (2984, 1524, "Duplex", "For Sale", "Alabama", 550000),
    (2322, 1682, "House", "For Sale", "Hawaii", 485000),
    (2030, 1097, "Duplex", "For Sale", "Hawaii", 620000),
    (2146, 1832, "Villa", "For Sale", "California", 700000),
    (2036, 1291, "Commercial Property", "For Sale", "Hawaii", 800000),
    (2065, 1109, "Industrial Property", "For Sale", "Hawaii", 750000),
    (2132, 1114, "House", "On Hold", "Florida", 580000),
    (2275, 1293, "Land/Plot", "For Sale", "Hawaii", 950000),
    (2675, 1109, "Industrial Property", "Sold", "Texas", 900000),
    (2368, 1254, "House", "For Sale", "Texas", 450000),
    (2402, 1561, "Apartment", "On Hold", "Hawaii", 180000),
    (2568, 1356, "Condominium", "For Sale", "Florida", 505000),
    (2674, 1478, "House", "For Sale", "Florida", 700000),
    (2734, 1524, "Duplex", "For Sale", "New York", 600000),
    (2885, 1682, "House", "For Sale", "Texas", 480000),
    (2069, 1114, "Villa", "Sold", "Texas", 458000),
    (2903, 1097, "Duplex", "For Sale", "New York", 550000),
    (2009, 1832, "Villa", "For Sale", "Texas", 750000),
    (2171, 1291, "Commercial Property", "For Sale", "Nevada", 805000),
    (2287, 1109, "Industrial Property", "For Sale", "Texas", 900000),
    (2053, 1114, "House", "For Sale", "Nevada", 585000),
    (2806, 1293, "Land/Plot", "Sold", "Alaska", 950000),
    (2288, 1109, "Apartment", "For Sale", "Texas", 550000),
    (2289, 1114, "Apartment", "For Sale", "Texas", 375000),
]

# contract_ID, property_ID, company_ID, date_contract, exclusivity
CONTRACTS = [
    (8001, 2651, 165, "2019-03-20", "Yes"),
    (8002, 2736, 995, "2020-06-11", "No"),
    (8003, 2095, 631, "2022-03-18", "Yes"),
    (8004, 2409, 652, "2019-05-06", "No"),
    (8005, 2984, 323, "2019-11-21", "Yes"),
    (8006, 2322, 753, "2022-03-15", "Yes"),
    (8007, 2030, 125, "2021-01-11", "No"),
    (8008, 2146, 787, "2023-02-01", "Yes"),
    (8009, 2036, 165, "2023-07-13", "Yes"),
    (8010, 2065, 995, "2020-02-03", "No"),
    (8011, 2065, 631, "2020-02-01", "Yes"),
    (8012, 2132, 753, "2021-12-20", "No"),
    (8013, 2275, 125, "2021-01-06", "Yes"),
    (8014, 2368, 631, "2019-02-15", "Yes"),
    (8015, 2402, 652, "2018-12-01", "No"),
    (8016, 2568, 323, "2021-12-01", "No"),
    (8017, 2674, 753, "2020-03-17", "No"),
    (8018, 2734, 323, "2023-01-23", "No"),
    (8019, 2885, 995, "2020-11-19", "Yes"),
    (8020, 2903, 995, "2020-10-04", "Yes"),
    (8021, 2009, 165, "2021-08-02", "No"),
    (8022, 2171, 631, "2023-06-01", "No"),
    (8023, 2287, 787, "2022-10-03", "Yes"),
    (8724, 2053, 631, "2021-12-05", "Yes"),
    (8531, 2107, 652, "2023-04-12", "No"),
    (8024, 2288, 787, "2022-10-13", "Yes"),
    (8025, 2289, 787, "2022-10-23", "Yes"),
]

# agent_ID, company_ID
AGENTS = [
    (3147, 165),
    (3782, 995),
    (3070, 631),
    (3904, 652),
    (3577, 323),
    (3907, 753),
    (3347, 125),
    (3502, 787),
    (3313, 165),
    (3914, 995),
    (3751, 631),
    (3265, 652),
    (3342, 165),
    (3404, 995),
    (3515, 631),
    (3546, 652),
    (3742, 323),
    (3958, 753),
    (3249, 125),
    (3514, 787),
    (3361, 165),
    (3242, 787),
]

# The agent that appears by name in a result.
AGENT_NAMES = {3242: ("Grace", "Garcia")}

# client_ID
CLIENTS = [
    4651, 4221, 4384, 4405, 4535, 4689, 4787, 4844, 4989, 4105,
    4111, 4126, 4139, 4147, 4155, 4169, 4174, 4180, 4191, 4202,
]

# The clients that appear by name in a result.
CLIENT_NAMES = {
    4787: ("Ava", "Davis"),
    4180: ("Isabella", "Anderson"),
    4126: ("Sophie", "Garcia"),
    4989: ("Emma", "Williams"),
    4202: ("Aria", "Garcia"),
}

# appointment_ID, agent_ID, client_ID, property_ID, date_appointment
APPOINTMENTS = [
    (6611, 3147, 4651, 2651, "2019-03-21"),
    (6012, 3782, 4221, 2736, "2020-06-12"),
    (6653, 3070, 4384, 2095, "2022-03-19"),
    (6324, 3904, 4405, 2409, "2019-05-07"),
    (6645, 3577, 4535, 2984, "2019-11-22"),
    (6056, 3907, 4689, 2322, "2022-03-16"),
    (6857, 3347, 4787, 2030, "2021-01-12"),
    (6238, 3502, 4844, 2146, "2023-02-02"),
    (6809, 3313, 4989, 2036, "2023-07-14"),
    (6610, 3914, 4105, 2065, "2020-02-04"),
    (6061, 3265, 4111, 2132, "2021-12-21"),
    (6312, 3342, 4126, 2275, "2021-01-07"),
    (6713, 3515, 4139, 2368, "2019-02-16"),
    (6853, 3546, 4147, 2402, "2018-12-02"),
    (6820, 3742, 4155, 2568, "2021-12-02"),
    (6841, 3958, 4169, 2674, "2020-03-18"),
    (6960, 3249, 4174, 2734, "2023-01-24"),
    (6354, 3514, 4180, 2885, "2020-11-20"),
    (6901, 3361, 4191, 2903, "2020-10-05"),
    (6805, 3242, 4202, 2009, "2022-10-04"),
]

# transaction_ID, property_ID, client_ID, agent_ID, review_process, date_transaction
TRANSACTIONS = [
    (5061, 2651, 4651, 3147, "8", "2019-04-25"),
    (5202, 2736, 4221, 3782, "1.2", "2020-07-10"),
    (5103, 2095, 4384, 3070, "3", "2022-04-02"),
    (5074, 2409, 4405, 3904, "5", "2019-08-06"),
    (5605, 2984, 4535, 3577, "9.2", "2020-01-02"),
    (5306, 2322, 4689, 3907, "4.5", "2022-05-03"),
    (5047, 2030, 4787, 3347, "4.5", "2021-02-18"),
    (5708, 2146, 4844, 3502, "2", "2023-03-30"),
    (5109, 2036, 4989, 3313, "1.9", "2023-08-20"),
    (5010, 2065, 4105, 3914, "9.7", "2020-04-23"),
    (5141, 2132, 4111, 3265, "9", "2022-07-18"),
    (5182, 2275, 4126, 3342, "8", "2021-08-14"),
    (5173, 2368, 4139, 3515, "3", "2019-03-22"),
    (5414, 2402, 4147, 3546, "3.4", "2018-12-31"),
    (5455, 2568, 4155, 3742, "4.1", "2022-02-13"),
    (5666, 2674, 4169, 3958, "6.6", "2020-05-06"),
    (5947, 2734, 4174, 3249, "8.7", "2023-02-11"),
    (5018, 2885, 4180, 3514, "2", "2021-03-08"),
    (5859, 2903, 4191, 3361, "4", "2020-10-07"),
    (5030, 2009, 4202, 3242, "6", "2022-12-22"),
    (5887, 2287, 4202, 3242, "3", "2022-10-04"),
    (5888, 2288, 4202, 3242, "8", "2022-10-14"),
    (5889, 2289, 4202, 3242, "9", "2022-10-24"),
]

# review_ID, property_ID, client_ID, date_review
REVIEWS = [
    (10851, 2651, 4651, "2019-05-11"),
    (10713, 2736, 4221, "2020-07-12"),
    (10835, 2095, 4384, "2022-04-18"),
    (10445, 2409, 4405, "2019-09-09"),
    (10528, 2984, 4535, "2020-01-03"),
    (10485, 2322, 4126, "2022-11-09"),
    (10745, 2030, 4202, "2021-10-11"),
    (10384, 2146, 4174, "2023-04-13"),
    (10968, 2036, 4989, "2023-08-31"),
    (10630, 2065, 4105, "2020-05-05"),
]


def day(text):
    return dt.date.fromisoformat(text)


def company_rows():
    return [(key, name, "Town") for key, name in COMPANIES]


def owner_rows():
    return [(key, "Owner", str(key), f"+1 {key}") for key in OWNERS]


def property_rows():
    return [(*row[:5], Decimal(1000), Decimal(row[5])) for row in PROPERTIES]


def contract_rows():
    return [(*row[:3], day(row[3]), row[4], "Standard terms") for row in CONTRACTS]


def agent_rows():
    return [
        (key, company, *AGENT_NAMES.get(key, ("Agent", str(key))), f"+2 {key}", Decimal("4.5"))
        for key, company in AGENTS
    ]


def client_rows():
    return [
        (key, *CLIENT_NAMES.get(key, ("Client", str(key))), f"+3 {key}", f"{key}@example.com", "House")
        for key in CLIENTS
    ]


def appointment_rows():
    kinds = ("Viewing", "Meeting", "")
    return [(*row[:4], day(row[4]), kinds[n % 3]) for n, row in enumerate(APPOINTMENTS)]


def transaction_rows():
    return [(*row[:4], Decimal(row[4]), day(row[5])) for row in TRANSACTIONS]


def visit_rows():
    outcomes = ("Y", "N", "Waiting")
    return [(9001 + n, row[0], outcomes[n % 3]) for n, row in enumerate(APPOINTMENTS[:10])]


def review_rows():
    return [(*row[:3], Decimal(4), "Comment", day(row[3])) for row in REVIEWS]


SALE_COLUMNS = [
    "transaction_ID", "property_ID", "client_ID", "agent_ID", "review_process", "date_transaction",
]


def batches(spark):
    return {
        "companies": literal_batch(spark, "companies", company_rows()),
        "owners": literal_batch(spark, "owners", owner_rows()),
        "properties": literal_batch(spark, "properties", property_rows()),
        "contracts_owner": literal_batch(spark, "contracts_owner", contract_rows()),
        "agents": literal_batch(spark, "agents", agent_rows()),
        "clients": literal_batch(spark, "clients", client_rows()),
        "appointments": literal_batch(spark, "appointments", appointment_rows()),
        "transactions": literal_batch(spark, "transactions", transaction_rows(), SALE_COLUMNS),
        "visits": literal_batch(spark, "visits", visit_rows()),
        "reviews": literal_batch(spark, "reviews", review_rows()),
    }
