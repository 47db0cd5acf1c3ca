"""Pipelines composed from the operators: storefront, refunds, marketplace, fees."""
