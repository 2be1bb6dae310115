"""Ready-made query plans over the driver tables, each paired with an ANSI oracle."""
