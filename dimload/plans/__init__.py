from .layout import ADDRESS_LAYOUT, ADDRESS_SCHEMA, CUSTOMER_SCHEMA, Tables

__all__ = ["ADDRESS_LAYOUT", "ADDRESS_SCHEMA", "CUSTOMER_SCHEMA", "Tables"]
