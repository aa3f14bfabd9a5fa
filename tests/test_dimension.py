"""Typed restaurant dimension."""

import pytest

from orderflow.operators import dimension


def one(listing, **fields):
    (row,) = dimension.restaurant_dimension(listing(fields)).collect()
    return row


@pytest.mark.parametrize(
    ("rate", "expected"),
    [
        ("4.1/5", 4.1), (" 3.9 /5", 3.9), ("NEW", 3.5), ("NEW/5", 3.5), ("-", 3.5), ("4-5", 3.5),
        ("", 3.5), (None, 3.5), ("abc", 3.5), ("4", 4.0),
    ],
)
def test_rate(listing, rate, expected):
    assert one(listing, rate=rate).rate == expected


@pytest.mark.parametrize(
    ("menu", "expected"),
    [
        ("['a', 'b', 'c', 'd', 'e', 'f']", ["a", "b", "c", "d", "e"]),
        ("['a', \"b's\"]", ["a", "b's", "Chef Special 3", "Chef Special 4", "Chef Special 5"]),
        ("['it\\'s', 'caf\\xe9',]", ["it's", "café", *[f"Chef Special {n}" for n in (3, 4, 5)]]),
        ("[]", [f"Chef Special {n}" for n in range(1, 6)]),
        ("none", [f"Chef Special {n}" for n in range(1, 6)]),
        ("{'a': 1}", [f"Chef Special {n}" for n in range(1, 6)]),
        (None, [f"Chef Special {n}" for n in range(1, 6)]),
    ],
)
def test_menu(listing, menu, expected):
    assert one(listing, menu_item=menu).menu_items == expected


def test_numbers_and_defaults(listing):
    row = one(listing, votes="x", cost="none")
    assert (row.votes, row.approx_cost) == (50, 600)
    row = one(listing, votes=" 12 ", cost=" 1,200 ")
    assert (row.votes, row.approx_cost) == (12, 1200)
    changed = dimension.restaurant_dimension(listing({"votes": None}), default_votes=0)
    assert changed.first().votes == 0


def test_texts(listing):
    row = one(
        listing,
        name="\t Spice ",
        online_order=" YES\n",
        book_table="y",
        phone="080 1\r\n+91 2,, 3 \n",
        cuisines="Thai,, North  Indian ,",
        city=None,
    )
    assert (row.name, row.online_order, row.book_table) == ("Spice", True, False)
    assert row.phone_numbers == ["080 1", "+91 2", "3"]
    assert row.dial_numbers == ["0801", "+912", "3"]
    assert row.cuisines == ["Thai", "North  Indian"]
    assert row.city == ""


def test_nameless_rows_are_dropped(listing):
    rows = listing({"name": None}, {"name": " \t"}, {"name": ""}, {})
    assert dimension.restaurant_dimension(rows).count() == 1


def test_popularity(listing):
    rows = listing(
        {"name": "a", "rate": "4/5", "votes": "10"},
        {"name": "b", "rate": "0.5/5", "votes": "40"},
        {"name": "c", "rate": "4/5", "votes": "-3"},
        {"name": "d", "rate": "2/5", "votes": "9", "city": "South"},
    )
    dim = dimension.restaurant_dimension(rows)
    top = dimension.popularity_rank(dim, 2).orderBy("city", "place")
    assert [(r.city, r.name, r.popularity) for r in top.collect()] == [
        ("North", "a", 40.0), ("North", "b", 40.0), ("South", "d", 18.0),
    ]
    counts = dimension.restaurants_by_city(dim).collect()
    assert {r.city: r.restaurant_count for r in counts} == {"North": 3, "South": 1}
