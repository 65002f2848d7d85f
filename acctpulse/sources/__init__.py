"""Raw inputs and outputs: schemas, CSV and table readers, view registration, writers, driver-table adapter."""
