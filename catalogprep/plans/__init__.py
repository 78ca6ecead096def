"""Query plans: the catalogue job, driver-table stand-ins, registered queries."""
