from aeris.cli import main

main()
