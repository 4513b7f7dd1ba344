"""Where rows come from and go to: tables, files, worksheets, databases."""
