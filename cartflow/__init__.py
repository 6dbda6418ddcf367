"""cartflow: shop-behaviour analytics as plain PySpark DataFrame functions."""
