"""Plans that string operators together: imports, migrations, requests."""
