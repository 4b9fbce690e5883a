"""Sources: landed JSON documents, processed CSV, named tables, driver tables."""
