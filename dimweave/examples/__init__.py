"""Every operator run over the driver's tables, with the SQL that checks it."""
