"""File map of the ticket-sales sample set (seven tables).

The files themselves are not part of this repository; give the folder that
holds them to ``sample_datasets``.
"""

from __future__ import annotations

from tideferry.sources.delimited import Dataset, Field

# File names, separators and column declarations of the set.
# "!" marks a required column; char/varchar lengths are upper bounds.
_TABLES = {
    "users": (
        "allusers_pipe.txt", "|",
        "userid int!, username char(8), firstname varchar(30), lastname varchar(30), "
        "city varchar(30), state char(2), email varchar(100), phone char(14), "
        "likesports boolean, liketheatre boolean, likeconcerts boolean, likejazz boolean, "
        "likeclassical boolean, likeopera boolean, likerock boolean, likevegas boolean, "
        "likebroadway boolean, likemusicals boolean",
    ),
    "venue": (
        "venue_pipe.txt", "|",
        "venueid smallint!, venuename varchar(100), venuecity varchar(30), "
        "venuestate char(2), venueseats int",
    ),
    "category": (
        "category_pipe.txt", "|",
        "catid smallint!, catgroup varchar(10), catname varchar(10), catdesc varchar(50)",
    ),
    "date": (
        "date2008_pipe.txt", "|",
        "dateid smallint!, caldate date!, day char(3)!, week smallint!, month char(5)!, "
        "qtr char(5)!, year smallint!, holiday boolean",
    ),
    "event": (
        "allevents_pipe.txt", "|",
        "eventid int!, venueid smallint!, catid smallint!, dateid smallint!, "
        "eventname varchar(200), starttime timestamp_ntz",
    ),
    "listing": (
        "listings_pipe.txt", "|",
        "listid int!, sellerid int!, eventid int!, dateid smallint!, numtickets smallint!, "
        "priceperticket decimal(8,2), totalprice decimal(8,2), listtime timestamp_ntz",
    ),
    "sales": (
        "sales_tab.txt", "\t",
        "salesid int!, listid int!, sellerid int!, buyerid int!, eventid int!, dateid smallint!, "
        "qtysold smallint!, pricepaid decimal(8,2), commission decimal(8,2), saletime timestamp_ntz",
    ),
}


def _field(text: str) -> Field:
    name, kind = text.split(" ", 1)
    required, kind = kind.endswith("!"), kind.rstrip("!")
    if "char" in kind:
        return Field(name, "string", required, int(kind[kind.index("(") + 1 : -1]))
    return Field(name, kind, required)


def sample_datasets(folder: str) -> dict[str, Dataset]:
    return {
        table: Dataset(
            table,
            f"{folder.rstrip('/')}/{file}",
            tuple(_field(column) for column in columns.split(", ")),
            sep,
        )
        for table, (file, sep, columns) in _TABLES.items()
    }
