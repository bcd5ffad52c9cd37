"""ordermill: order analytics as Spark jobs.

Raw order tables and an order-event stream go in; staging views, a star schema,
a daily revenue mart, data-quality reports and business metrics come out. Every
operator is a function from DataFrames to a DataFrame.
"""
