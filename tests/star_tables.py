"""Small star tables for the tests, in a module of their own name so that nested conftest files cannot shadow it."""

import datetime as dt
from decimal import Decimal

from tillscope.sources.dims import build_dim_channel, build_dim_date
from tillscope.sources.schema import SCHEMAS
from tillscope.sources.star import Star

SMOKE = "/root/testdata/sf0.001"


def _frame(spark, table, rows):
    schema = SCHEMAS[table]
    full = []
    for r in rows:
        full.append(tuple(r.get(f.name) for f in schema.fields))
    return spark.createDataFrame(full, schema=schema)


def D(x):
    return Decimal(str(x)).quantize(Decimal("0.01"))


def order(order_id, customer_id, day, total, status="Completed", channel_id=1):
    return {"order_id": order_id, "order_number": f"ORD-{order_id:07d}", "customer_id": customer_id,
            "order_date_id": int(day.strftime("%Y%m%d")), "channel_id": channel_id, "order_status": status,
            "order_subtotal": D(total), "order_tax": D(0), "order_shipping": D(0), "order_discount": D(0),
            "order_total": D(total), "created_at": dt.datetime.combine(day, dt.time())}


def item(item_id, order_id, product_id, qty, line_total):
    return {"order_item_id": Decimal(item_id), "order_id": order_id, "product_id": product_id, "quantity": qty,
            "unit_price": D(line_total / qty if qty else 0), "unit_discount": D(0), "line_subtotal": D(line_total),
            "line_discount_total": D(0), "line_total": D(line_total)}


def customer(cid, segment="Retail", created=None):
    return {"customer_id": cid, "customer_key": f"CUST-{cid:05d}", "first_name": f"F{cid}", "last_name": f"L{cid}",
            "segment": segment, "created_date": created, "country": "X", "region": "R", "city": "C"}


def product(pid, category="Home", subcategory="Decor", cost=1.0, name=None, active=True):
    return {"product_id": pid, "product_sku": f"SKU-{pid:05d}", "product_name": name or f"P{pid}", "brand": "B",
            "category": category, "subcategory": subcategory, "list_price": D((cost or 1) * 2),
            "cost": None if cost is None else D(cost), "is_active": active}


def make_star(spark, customers, products, orders, items, start=dt.date(2020, 1, 1), end=dt.date(2022, 12, 31)):
    return Star(
        customer=_frame(spark, "dim_customer", customers),
        product=_frame(spark, "dim_product", products),
        date=build_dim_date(spark, start, end),
        channel=build_dim_channel(spark),
        orders=_frame(spark, "fact_order", orders),
        items=_frame(spark, "fact_order_item", items),
    )
