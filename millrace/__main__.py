from millrace.cli import main

main()
