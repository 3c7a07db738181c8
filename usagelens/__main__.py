from usagelens.cli import main

raise SystemExit(main())
