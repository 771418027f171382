"""Small business-case tables."""

import datetime as dt
from decimal import Decimal


def d(text):
    return dt.date.fromisoformat(text)


def t(text):
    return dt.datetime.fromisoformat(text)


# The rows of the small tables and the sample customers of the subscription table.
ROWS = {
    "sales": [
        ("A", d("2021-01-01"), 1), ("A", d("2021-01-01"), 2), ("A", d("2021-01-07"), 2), ("A", d("2021-01-10"), 3),
        ("A", d("2021-01-11"), 3), ("A", d("2021-01-11"), 3), ("B", d("2021-01-01"), 2), ("B", d("2021-01-02"), 2),
        ("B", d("2021-01-04"), 1), ("B", d("2021-01-11"), 1), ("B", d("2021-01-16"), 3), ("B", d("2021-02-01"), 3),
        ("C", d("2021-01-01"), 3), ("C", d("2021-01-01"), 3), ("C", d("2021-01-07"), 3),
    ],
    "menu": [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)],
    "members": [("A", d("2021-01-07")), ("B", d("2021-01-09"))],
    "runners": [(1, d("2021-01-01")), (2, d("2021-01-03")), (3, d("2021-01-08")), (4, d("2021-01-15"))],
    "customer_orders": [
        (1, 101, 1, "", "", t("2020-01-01 18:05:02")),
        (2, 101, 1, "", "", t("2020-01-01 19:00:52")),
        (3, 102, 1, "", "", t("2020-01-02 23:51:23")),
        (3, 102, 2, "", None, t("2020-01-02 23:51:23")),
        (4, 103, 1, "4", "", t("2020-01-04 13:23:46")),
        (4, 103, 1, "4", "", t("2020-01-04 13:23:46")),
        (4, 103, 2, "4", "", t("2020-01-04 13:23:46")),
        (5, 104, 1, "null", "1", t("2020-01-08 21:00:29")),
        (6, 101, 2, "null", "null", t("2020-01-08 21:03:13")),
        (7, 105, 2, "null", "1", t("2020-01-08 21:20:29")),
        (8, 102, 1, "null", "null", t("2020-01-09 23:54:33")),
        (9, 103, 1, "4", "1, 5", t("2020-01-10 11:22:59")),
        (10, 104, 1, "null", "null", t("2020-01-11 18:34:49")),
        (10, 104, 1, "2, 6", "1, 4", t("2020-01-11 18:34:49")),
    ],
    "runner_orders": [
        (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
        (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
        (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None),
        (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
        (5, 3, "2020-01-08 21:10:57", "10", "15", None),
        (6, 3, "null", "null", "null", "Restaurant Cancellation"),
        (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"),
        (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", "null"),
        (9, 2, "null", "null", "null", "Customer Cancellation"),
        (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", "null"),
    ],
    "pizza_names": [(1, "Meatlovers"), (2, "Vegetarian")],
    "pizza_recipes": [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")],
    "pizza_toppings": [
        (1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"), (6, "Mushrooms"), (7, "Onions"),
        (8, "Pepperoni"), (9, "Peppers"), (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce"),
    ],
    "ratings": [(1, 1, 5), (2, 2, 4), (3, 3, 5), (4, 4, 3), (5, 5, 1), (6, 7, 1), (7, 8, 2), (8, 10, 5)],
    "plans": [
        (0, "trial", Decimal("0.00")), (1, "basic monthly", Decimal("9.90")), (2, "pro monthly", Decimal("19.90")),
        (3, "pro annual", Decimal("199.00")), (4, "churn", None),
    ],
    "subscriptions": [
        (1, 0, d("2020-08-01")), (1, 1, d("2020-08-08")),
        (2, 0, d("2020-09-20")), (2, 3, d("2020-09-27")),
        (13, 0, d("2020-12-15")), (13, 1, d("2020-12-22")), (13, 2, d("2021-03-29")),
        (15, 0, d("2020-03-17")), (15, 2, d("2020-03-24")), (15, 4, d("2020-04-29")),
        (16, 0, d("2020-05-31")), (16, 1, d("2020-06-07")), (16, 3, d("2020-10-21")),
        (18, 0, d("2020-07-06")), (18, 2, d("2020-07-13")),
        (19, 0, d("2020-06-22")), (19, 2, d("2020-06-29")), (19, 3, d("2020-08-29")),
    ],
}

# The expected payments of the sample customers up to the end of 2020.
PAYMENTS = [
    (1, "basic monthly", "2020-08-08", "9.90", 1), (1, "basic monthly", "2020-09-08", "9.90", 2),
    (1, "basic monthly", "2020-10-08", "9.90", 3), (1, "basic monthly", "2020-11-08", "9.90", 4),
    (1, "basic monthly", "2020-12-08", "9.90", 5),
    (2, "pro annual", "2020-09-27", "199.00", 1),
    (13, "basic monthly", "2020-12-22", "9.90", 1),
    (15, "pro monthly", "2020-03-24", "19.90", 1), (15, "pro monthly", "2020-04-24", "19.90", 2),
    (16, "basic monthly", "2020-06-07", "9.90", 1), (16, "basic monthly", "2020-07-07", "9.90", 2),
    (16, "basic monthly", "2020-08-07", "9.90", 3), (16, "basic monthly", "2020-09-07", "9.90", 4),
    (16, "basic monthly", "2020-10-07", "9.90", 5), (16, "pro annual", "2020-10-21", "189.10", 6),
    (18, "pro monthly", "2020-07-13", "19.90", 1), (18, "pro monthly", "2020-08-13", "19.90", 2),
    (18, "pro monthly", "2020-09-13", "19.90", 3), (18, "pro monthly", "2020-10-13", "19.90", 4),
    (18, "pro monthly", "2020-11-13", "19.90", 5), (18, "pro monthly", "2020-12-13", "19.90", 6),
    (19, "pro monthly", "2020-06-29", "19.90", 1), (19, "pro monthly", "2020-07-29", "19.90", 2),
    (19, "pro annual", "2020-08-29", "199.00", 3),
]
